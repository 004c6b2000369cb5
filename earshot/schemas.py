"""Declared schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T



def _struct(text: str) -> T.StructType:
    """Build a struct type from ``name type, name type`` without needing a session."""
    out = T.StructType()
    for part in text.split(","):
        name, kind = part.split()
        out.add(name, "integer" if kind == "int" else kind)
    return out


# The label types in their order, and those that get validated.
LABEL_TYPES = ["Sentiment", "Workload", "Support", "Platform"]
VALIDATED_TYPES = ["Sentiment", "Workload", "Platform"]
LABEL_COLUMNS = [f"{t}Label" for t in LABEL_TYPES]


FACT_SURVEY = _struct(
    "FeedbackId string, SurveyComment string, SurveyType string, InternalResponseFlag string,"
    " DIM_ProductMasterId int, DIM_DateId int, Score int"
)

COMMENT_DIM = _struct(
    "SurveyType string, CommentId string, SurveyComment string, FirstResponseDate int,"
    " LastResponseDate int, TokenCount long, ProcessingDate int, ReportingDate int,"
    " CharacterCount long, ResponseCount long"
)

# The same without the texts: what the daily job rewrites when work states change.
COMMENT_STATE = T.StructType([f for f in COMMENT_DIM.fields if f.name != "SurveyComment"])
COMMENT_TEXT = _struct("CommentId string, SurveyComment string")
# Texts are kept in slices by the first character of the id, so that removing some rewrites their slices only.
SLICED_TEXT = _struct("CommentId string, SurveyComment string, Slice string")

# Responses per comment of each partition of the fact, and the partitions' marks.
COMMENT_COUNTS = _struct("SurveyType string, CommentId string, ResponseCount long, DIM_DateId int")
FACT_MARKS = _struct("Partition int, Mark string")

NONRESPONSE_DIM = _struct(
    "SurveyType string, CommentId string, SurveyComment string, ResponseCount long"
)

DUPLICATE_MAP = _struct(
    "CommentId string, KnownCommentId string, SurveyComment string,"
    " SurveyCommentDeduped string, ReportingDate int"
)

SEGMENTS = _struct(
    "CommentId string, Segment string, SegmentNumber long, Coverage double,"
    " CumulativeCoverage double, RunDateId int"
)

LABELS_LONG = _struct(
    "CommentId string, Segment string, SegmentNumber long, Coverage double,"
    " CumulativeCoverage double, RunDateId int, LabelType string, Label string"
)

VALIDATION = _struct("Consensus string, Justification string")

LABELLED = _struct(
    "CommentId string, Segment string, SegmentNumber long, Coverage double,"
    " CumulativeCoverage double, SentimentLabel string, WorkloadLabel string,"
    " SupportLabel string, PlatformLabel string, RunDateId int"
)

RELABELLED = T.StructType(
    LABELLED.fields
    + [
        field
        for t in ["Platform", "Sentiment", "Workload"]
        for field in (
            T.StructField(f"{t}_iteration", T.IntegerType()),
            T.StructField(f"{t}Label_iteration0", T.StringType()),
            T.StructField(f"{t}Label_validation", VALIDATION),
        )
    ]
)

MESSAGES = T.ArrayType(_struct("role string, content string, name string"))

COMPLETIONS = T.StructType(
    [
        T.StructField("PromptId", T.StringType()),
        T.StructField("content", T.ArrayType(T.StringType())),
        T.StructField("finish_reason", T.ArrayType(T.StringType())),
        T.StructField("error", _struct("code string, message string")),
        T.StructField("id", T.StringType()),
        T.StructField("created", T.LongType()),
    ]
)

# Completions as they are kept, with the day they were asked for.
ANSWERS = T.StructType([*COMPLETIONS.fields, T.StructField("AskedOn", T.IntegerType())])

# Report rows while they are being worked on: the comment's id stands for its text.
REPORT = _struct(
    "DIM_DateId int, DIM_ProductMasterId int, FeedbackId string, CommentId string, Segment string, SegmentNumber long, Coverage double,"
    " CumulativeCoverage double, SentimentLabel string, WorkloadLabel string,"
    " SupportLabel string, PlatformLabel string, Score int, ReportingType string,"
    " WorkloadLabel_original string, UserContext string"
)

REPORT_OUT = T.StructType(
    [
        *REPORT.fields[:4],
        T.StructField("SurveyComment", T.StringType()),
        *REPORT.fields[4:],
        T.StructField("Predicted_DIM_ProductMasterId", T.IntegerType()),
        T.StructField("SurveyType", T.StringType()),
    ]
)

# The same without the texts.
REPORT_ROWS = T.StructType([f for f in REPORT_OUT.fields if f.name != "SurveyComment"])

QC = _struct(
    "DIM_DateId int, LabelType string, LabelValue string, DistinctResponseCount long,"
    " IssueFlag boolean, SurveyType string"
)

SEARCH_ROWS = _struct(
    "FeedbackId string, SegmentNumber long, ReportingDate int, SurveyType string"
)

METRICS = _struct("Stage string, Metric string, Value double, RunDateId int")

CHECKS = _struct("Stage string, Check string, Expected long, Actual long, Ok boolean")
