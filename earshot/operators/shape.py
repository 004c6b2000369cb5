"""Row filters, typed columns and column renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot import config
from earshot.functions.dates import date_string, parsed_date
from earshot.functions.text import comment_id
from earshot.operators.skew import lookup_join

# Columns of a report row that only a labelled segment fills.
SEGMENT_FIELDS = T.StructType(
    [
        T.StructField("Segment", T.StringType()),
        T.StructField("SegmentNumber", T.LongType()),
        T.StructField("Coverage", T.DoubleType()),
        T.StructField("CumulativeCoverage", T.DoubleType()),
        T.StructField("SentimentLabel", T.StringType()),
        T.StructField("WorkloadLabel", T.StringType()),
        T.StructField("SupportLabel", T.StringType()),
        T.StructField("PlatformLabel", T.StringType()),
        T.StructField("UserContext", T.StringType()),
    ]
)


def with_comment_id(df: DataFrame) -> DataFrame:
    """Add the fixed-width join key of the comment text."""
    return df.withColumn("CommentId", comment_id(F.col("SurveyComment")))


def _is_empty() -> Column:
    return F.col("SurveyComment").isNull() | (F.col("SurveyComment") == "")


def has_empty_id() -> Column:
    """The same told by the comment's id, where the text is not at hand."""
    return F.col("CommentId").isNull() | (F.col("CommentId") == comment_id(F.lit("")))


def eligible_for_report(fact: DataFrame, survey_type: str, cutoff: int) -> DataFrame:
    """External responses of one survey type from the cutoff date on, comments or not."""
    return fact.filter(
        (F.col("SurveyType") == survey_type)
        & (F.col("InternalResponseFlag") == "False")
        & (F.col("DIM_DateId") >= cutoff)
    )


def eligible_responses(fact: DataFrame, survey_type: str, cutoff: int) -> DataFrame:
    """The same, with a comment."""
    return eligible_for_report(fact, survey_type, cutoff).filter(~_is_empty())


def product_allowlist(df: DataFrame, products: Sequence[int] | DataFrame) -> DataFrame:
    """Rows of the configured products, given as a short list or as a table."""
    if isinstance(products, DataFrame):
        wanted = products.select(F.col(products.columns[0]).alias("DIM_ProductMasterId")).distinct()
        return lookup_join(df, wanted, ["DIM_ProductMasterId"], "left_semi")
    return df.filter(F.col("DIM_ProductMasterId").isin(list(products)))


def typed_backfill(
    df: DataFrame, schema: T.StructType, constants: Mapping[str, object] | None = None
) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed nulls or the given constants."""
    constants = dict(constants or {})
    missing = {
        f.name: F.lit(constants.get(f.name)).cast(f.dataType)
        for f in schema.fields
        if f.name not in df.columns
    }
    extra = {c: F.lit(v) for c, v in constants.items() if c not in missing}
    return df.withColumns({**missing, **extra}) if missing or extra else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order the columns and cast each to its declared type; unreadable values become null."""
    return df.select(
        *[
            (
                F.col(f.name)
                if df.schema[f.name].dataType == f.dataType
                else F.col(f.name).try_cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_responses(eligible: DataFrame) -> DataFrame:
    """Responses without a comment as report rows of kind ``Empty``."""
    empty = _is_empty() if "SurveyComment" in eligible.columns else has_empty_id()
    return typed_backfill(eligible.filter(empty), SEGMENT_FIELDS, {"ReportingType": "Empty"})


def rename_labels(df: DataFrame, column: str, mapping: Mapping[str, object] | DataFrame) -> DataFrame:
    """Replace a label by its mapped name; a label without one becomes null.

    A dictionary is a closed list and becomes a literal of the plan; a table has the label in
    its first column and the name in its second.
    """
    if isinstance(mapping, DataFrame):
        key, value = mapping.columns[:2]
        table = mapping.select(F.col(key).alias(column), F.col(value).alias("_name"))
        named = lookup_join(df, table, [column], "left")
        return named.withColumn(column, F.col("_name")).select(*df.columns)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return df.withColumn(column, F.create_map(*pairs)[F.col(column)])


def workload_names(labels: DataFrame, column: str = "WorkloadLabel") -> DataFrame:
    """Plain name of each stored workload label, by rule instead of by list."""
    label = F.col(column)
    prefix = config.VENDOR_PREFIX
    return labels.withColumn(
        column,
        F.when(label == config.NOT_APPLICABLE, config.GENERIC_WORKLOAD)
        .when(label == config.GENERIC_WORKLOAD, label)
        .otherwise(F.replace(label, F.lit(prefix), F.lit(""))),
    )


def predicted_product_id(df: DataFrame) -> DataFrame:
    """Show the display name, keep the stored label, and add the product id of the name."""
    if "WorkloadLabel_original" not in df.columns:
        df = df.withColumn("WorkloadLabel_original", F.col("WorkloadLabel"))
    named = rename_labels(df.withColumn("WorkloadLabel", F.col("WorkloadLabel_original")), "WorkloadLabel", config.WORKLOAD_DISPLAY)
    coded = named.withColumn("Predicted_DIM_ProductMasterId", F.col("WorkloadLabel"))
    return rename_labels(coded, "Predicted_DIM_ProductMasterId", config.WORKLOAD_PRODUCT)


def context_normalise(context: DataFrame) -> DataFrame:
    """(FeedbackId, UserContext) from a comma list; a null list becomes an empty text."""
    return context.select(
        "FeedbackId", F.concat_ws(",", F.split("Value", ",")).alias("UserContext")
    )


def date_ids(df: DataFrame, column: str, today: int) -> DataFrame:
    """Add DateString, DateInt and Rejected for a date given as text; absent means today."""
    text = F.col(column)
    absent = text.isNull() | (text == "")
    day = parsed_date(F.when(absent, F.lit(str(today))).otherwise(text))
    return df.withColumns(
        {
            "DateString": date_string(day),
            "DateInt": date_string(day).cast("int"),
            "Rejected": day.isNull(),
        }
    )
