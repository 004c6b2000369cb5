"""Input views over the given tables, as SQL text that both engines run unchanged.

Two days of one survey: day 1 is everything dated up to DAY1; day 2 is the whole fact without
responses labelled toxic (withdrawn) and with the date of those of quality 0 moved by a day
(restated). Nulls, empties, one-character comments and internal rows are planted.
"""

from __future__ import annotations

SURVEY = "NPS"
CUTOFF = 20231105
DAY1 = 20231118
DAY2 = 20231129

# Views in terms of the given tables ({documents}, ...) and of each other.
VIEWS = {
    "fact_survey": """
        SELECT CAST(doc_id AS STRING) AS FeedbackId,
               CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 37 = 0 THEN ''
                    WHEN doc_id % 43 = 0 THEN '?' ELSE text END AS SurveyComment,
               CASE WHEN source = 'src0' THEN 'CSAT' ELSE 'NPS' END AS SurveyType,
               CASE WHEN doc_id % 10 = 9 THEN 'True' ELSE 'False' END AS InternalResponseFlag,
               CAST(10 + doc_id % 8 AS INT) AS DIM_ProductMasterId,
               CAST(20231101 + (doc_id % 28) AS INT) AS DIM_DateId,
               CAST(doc_id % 11 AS INT) AS Score
        FROM {documents}""",
    "day1": f"SELECT * FROM {{fact_survey}} WHERE DIM_DateId <= {DAY1}",
    "day2": """
        SELECT f.FeedbackId, f.SurveyComment, f.SurveyType, f.InternalResponseFlag,
               f.DIM_ProductMasterId,
               CAST(f.DIM_DateId + CASE WHEN l.quality = 0 THEN 1 ELSE 0 END AS INT) AS DIM_DateId,
               f.Score
        FROM {fact_survey} f LEFT JOIN {labels} l ON f.FeedbackId = CAST(l.doc_id AS STRING)
        WHERE COALESCE(l.toxic, 0) = 0""",
    "context": """
        SELECT CAST(c_custkey - c_custkey % 3 AS STRING) AS FeedbackId,
               CASE WHEN c_acctbal < 0 THEN NULL
                    WHEN c_custkey % 5 = 0 THEN c_mktsegment
                    ELSE concat(c_mktsegment, ',', c_name) END AS Value
        FROM {customer}""",
    "date_texts": """
        SELECT doc_id,
               CASE WHEN source = 'src1' THEN NULL WHEN source = 'src2' THEN ''
                    WHEN source = 'src3' THEN lang
                    WHEN source = 'src4' THEN concat('2023-13-', CAST(10 + doc_id % 18 AS STRING))
                    WHEN n_chars % 2 = 0 THEN concat('202311', CAST(10 + doc_id % 18 AS STRING))
                    ELSE concat('2023-11-', CAST(10 + doc_id % 18 AS STRING)) END AS DateText
        FROM {documents}""",
    "listing": """
        SELECT DISTINCT CASE WHEN lang = 'fr' THEN concat('labeled_buffer_', source)
                    WHEN lang = 'es' THEN concat('dim_', source, '_202311', CAST(10 + doc_id % 18 AS STRING))
                    WHEN lang = 'de' THEN concat('labels_buffer_20239999_', source)
                    ELSE concat('segmented_buffer_202311', CAST(10 + doc_id % 18 AS STRING), '_', source)
               END AS name
        FROM {documents}""",
    "search_before": """
        SELECT CAST(l_orderkey AS STRING) AS FeedbackId, CAST(l_linenumber AS BIGINT) AS SegmentNumber,
               CASE WHEN l_returnflag = 'R' THEN 'CSAT' ELSE 'NPS' END AS SurveyType,
               MAX(CAST(20231118 AS INT)) AS ReportingDate
        FROM {lineitem} WHERE l_linestatus = 'F' OR l_quantity > 25
        GROUP BY 1, 2, 3""",
    "search_after": """
        SELECT CAST(l_orderkey AS STRING) AS FeedbackId, CAST(l_linenumber AS BIGINT) AS SegmentNumber,
               CASE WHEN l_returnflag = 'R' THEN 'CSAT' ELSE 'NPS' END AS SurveyType,
               MAX(CAST(CASE WHEN l_discount > 0.05 THEN 20231129 ELSE 20231118 END AS INT)) AS ReportingDate
        FROM {lineitem} WHERE l_linestatus = 'O' OR l_quantity <= 40
        GROUP BY 1, 2, 3""",
    "event_keys": """
        SELECT CAST(user_id AS STRING) AS FeedbackId, event_type AS SurveyType FROM {events}""",
}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class _Plain(dict):
    def __missing__(self, key: str) -> str:
        return key


def plain(name: str) -> str:
    """Text of a view for an engine where tables and views go by their names."""
    return VIEWS[name].format_map(_Plain())
