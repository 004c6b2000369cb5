"""Closed labels: snapping, joining label types, validation, the second round."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot import config
from earshot.functions.text import bind, closest_label, closest_match
from earshot.operators.completions import ANSWER_COLUMNS
from earshot.operators.shape import rename_labels
from earshot.operators.skew import lookup_join
from earshot.schemas import LABEL_TYPES

SEGMENT_KEY = ["CommentId", "SegmentNumber"]
SEGMENT_BODY = ["Segment", "Coverage", "CumulativeCoverage", "RunDateId"]


def snap_to_vocabulary(
    df: DataFrame,
    label_types: Sequence[str] = tuple(LABEL_TYPES),
    floor: float = 0.0,
    extra_workloads: Sequence[str] = (),
) -> DataFrame:
    """Replace each free-text label by the closest entry of its closed list.

    With a floor, labels unlike every entry become null; floor 0 always answers.
    """
    lists = {
        t: config.vocabulary(t, tuple(extra_workloads) if t == "Workload" else ())
        for t in label_types
    }
    return df.withColumns(
        {f"{t}Label": closest_label(F.col(f"{t}Label"), lists[t], floor) for t in label_types}
    )


def rejected_labels(
    df: DataFrame,
    floor: float,
    label_types: Sequence[str] = tuple(LABEL_TYPES),
    extra_workloads: Sequence[str] = (),
) -> DataFrame:
    """Labels that ``snap_to_vocabulary`` turns to null: the raw text, the closest entry and its score, one row each.

    Raw labels repeat, so each distinct one is scored once.
    """
    long = df.unpivot(SEGMENT_KEY, [f"{t}Label" for t in label_types], "LabelType", "RawLabel").withColumn(
        "LabelType", F.regexp_replace("LabelType", "Label$", "")
    )
    best = None
    for t in label_types:
        entries = config.vocabulary(t, tuple(extra_workloads) if t == "Workload" else ())
        match = F.when(~F.col("RawLabel").isin(entries), closest_match(F.col("RawLabel"), entries))
        best = F.when(F.col("LabelType") == t, match) if best is None else best.when(F.col("LabelType") == t, match)
    raws = long.filter(F.col("RawLabel").isNotNull()).select("LabelType", "RawLabel").distinct()
    low = raws.withColumn("_best", best).filter(F.col("_best")["score"] < floor)
    low = low.select("LabelType", "RawLabel", F.col("_best")["label"].alias("Closest"), F.col("_best")["score"].alias("Score"))
    return lookup_join(long, low, ["LabelType", "RawLabel"], "inner").select(*SEGMENT_KEY, "LabelType", "RawLabel", "Closest", "Score")


def join_on(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join by name(s), keeping one copy of the key columns."""
    return left.join(right, [on] if isinstance(on, str) else list(on), how)


def multi_join(frames: Sequence[DataFrame], on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join any number of frames on the same columns."""
    return reduce(lambda a, b: join_on(a, b, on, how), frames)


def labels_wide(
    long: DataFrame, label_types: Sequence[str], values: Sequence[str] = ("Label",)
) -> DataFrame:
    """One row per segment with a column per label type; segments lacking a type drop out.

    ``long`` has one row per segment and label type. One aggregate replaces a join per type,
    and the keys are the comment and the segment number, never a coverage figure.
    """
    picked = [
        F.first(F.when(F.col("LabelType") == t, F.col(v)), ignorenulls=True).alias(
            f"{t}Label" if v == "Label" else f"{t}{v}"
        )
        for t in label_types
        for v in values
    ]
    body = [F.first(c).alias(c) for c in SEGMENT_BODY if c in long.columns]
    seen = F.bit_or(
        reduce(
            lambda other, pair: F.when(F.col("LabelType") == pair[1], 1 << pair[0]).otherwise(other),
            enumerate(label_types),
            F.lit(0),
        )
    )
    return (
        long.groupBy(*SEGMENT_KEY)
        .agg(*body, *picked, seen.alias("_seen"))
        .filter(F.col("_seen") == (1 << len(label_types)) - 1)
        .drop("_seen")
    )


def rename_workloads(df: DataFrame, second_round: bool = False) -> DataFrame:
    """Stored workload labels to plain names."""
    extra = (config.GENERIC_WORKLOAD,) if second_round else ()
    names = config.workload_names(config.vocabulary("Workload", extra))
    return rename_labels(df, "WorkloadLabel", names)


def _strip_start(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substr(text, F.lit(len(prefix) + 1))).otherwise(
        text
    )


def parse_consensus(answer: Column) -> Column:
    """struct(Consensus, Justification) of a validation answer.

    The first line is snapped to Agree or Disagree; what is left of it stands in for a missing
    second part, or a blank when nothing is left.
    """

    def parsed(halves: Column) -> Column:
        line, rest = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))
        return bind(
            F.struct(
                line.alias("line"),
                rest.alias("rest"),
                closest_label(line, config.CONSENSUS_VALUES).alias("value"),
            ),
            lambda p: F.struct(
                p["value"].alias("Consensus"),
                F.coalesce(p["rest"], _leftover(p["line"], p["value"])).alias("Justification"),
            ),
        )

    def _leftover(line: Column, value: Column) -> Column:
        left = _strip_start(_strip_start(F.replace(line, value, F.lit("")), ". "), ".")
        return F.when(F.length(left) > 1, left).otherwise(F.lit(" "))

    return F.when(answer.isNotNull(), bind(F.split(answer, "\n", 2), parsed))


def contradiction_override(validation: Column) -> Column:
    """Turn a Disagree whose reason argues for the label into an Agree with a fixed note."""

    def turned(given: Column) -> Column:
        argues = reduce(
            lambda a, b: a | b,
            [given["Justification"].like(p) for p in config.CONTRADICTION_PATTERNS],
        )
        agree = F.struct(
            F.lit("Agree").alias("Consensus"),
            F.lit(config.CONTRADICTION_NOTE).alias("Justification"),
        )
        return F.when((given["Consensus"] == "Disagree") & argues, agree).otherwise(given)

    return bind(validation, turned)


def validated(completed: DataFrame, label_type: str) -> DataFrame:
    """The first answer as ``<X>Label_validation``, contradictions turned."""
    parsed = parse_consensus(F.get("content", F.lit(0)))
    return (
        completed.withColumn("_v", parsed)
        .withColumn(f"{label_type}Label_validation", contradiction_override(F.col("_v")))
        .drop("_v", *ANSWER_COLUMNS)
    )


def agreed(label_type: str) -> Column:
    """True where the label was agreed to; no validation counts as not agreed."""
    return F.coalesce(
        F.col(f"{label_type}Label_validation")["Consensus"] == "Agree", F.lit(False)
    )


def relabel_round(rows: DataFrame, second: DataFrame, label_type: str) -> DataFrame:
    """Keep agreed labels as round 0 and take the second round's label for the others.

    ``second`` has (CommentId, SegmentNumber, <X>Label) for rows that were not agreed to. A comment
    counts as a whole: if one of its rows is neither agreed to nor answered again, all its rows
    drop out and the comment stays unprocessed. Both kinds keep the first label.
    """
    column = f"{label_type}Label"
    answers = second.select(
        *SEGMENT_KEY, F.col(column).alias("_second"), F.lit(True).alias("_answered")
    )
    settled = agreed(label_type) | F.coalesce("_answered", F.lit(False))
    open_rows = F.count_if(~settled).over(Window.partitionBy("CommentId"))
    both = rows.join(answers, SEGMENT_KEY, "left").withColumn("_open", open_rows).filter("_open = 0")
    first = F.col(column)
    return both.withColumns(
        {
            f"{label_type}_iteration": F.when(agreed(label_type), 0).otherwise(1),
            f"{column}_iteration0": first,
            column: F.when(agreed(label_type), first).otherwise(F.col("_second")),
        }
    ).drop("_second", "_answered", "_open")


def vocabulary_table(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, Label, Rank) from newline texts: all lines but the first and the last, in order."""
    lines = F.split(text, "\n")
    inner = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0)))
    return texts.select(key, F.posexplode(inner).alias("Rank", "Label"))


def instructions(work: DataFrame, prompts: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach the instruction text of each (stage, label type) to rows of work."""
    return lookup_join(work, prompts, on, "inner")
