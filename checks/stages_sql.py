"""The stage frames of the two-day run again, as SQL text for an independent engine.

Each entry is one common table expression; :func:`complete` prefixes a query with those it uses.
"""

from __future__ import annotations

import re

from checks.views import CUTOFF, DAY1, DAY2, SURVEY, VIEWS, plain
from earshot import config
from earshot.schemas import LABEL_TYPES, REPORT

PRODUCTS = ", ".join(str(p) for p in config.product_ids())

# The same line breaks and blanks as the library, in the other engine's notation.
LINE_BREAKS = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
BLANKS = "||".join(
    f"chr({n})"
    for n in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(entries: list[str]) -> str:
    return "[" + ", ".join(quoted(e) for e in entries) + "]"


def words(text: str) -> str:
    return (
        rf"list_distinct(string_split_regex(regexp_replace({text}, '[!?\-]+', '', 'g'),"
        r" '[ ,.;:\"'']+'))".replace(r"\"", '"')
    )


def norm(text: str) -> str:
    return rf"trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' ')"


def score(raw: str, entry: str) -> str:
    return (
        f"round(CASE WHEN {raw} = {entry} THEN 1.0"
        f" WHEN length({raw}) > 0 AND (contains(' ' || {raw} || ' ', ' ' || {entry} || ' ')"
        f" OR contains(' ' || {entry} || ' ', ' ' || {raw} || ' ')) THEN 0.9"
        f" ELSE 1.0 - levenshtein({raw}, {entry})::DOUBLE / greatest(length({raw}), length({entry})) END, 9)"
    )


def snap_table(raws: str, entries: list[str]) -> str:
    """(raw, label): closest entry for each distinct raw text of the given one-column query."""
    return f"""
        SELECT raw, label FROM (
            SELECT raw, label, row_number() OVER (PARTITION BY raw ORDER BY
                   CASE WHEN raw = label THEN 2.0 ELSE {score(norm('raw'), norm('label'))} END DESC, rank) AS place
            FROM ({raws}),
                 (SELECT unnest({sql_list(entries)}) AS label,
                         generate_subscripts({sql_list(entries)}, 1) AS rank))
        WHERE place = 1"""


def raw_label(kind: str) -> str:
    entries = config.vocabulary(kind)
    picked = f"list_extract({sql_list(entries)}, length(Segment) % {len(entries)} + 1)"
    return (
        f"CASE WHEN length(Segment) % 3 = 0 THEN lower({picked}) || '.'"
        f" WHEN length(Segment) % 3 = 1 THEN replace({picked}, 'e', '') ELSE {picked} END"
    )


def case_map(column: str, mapping: dict[str, object]) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


def eligible(day: str, with_text: bool) -> str:
    text = "AND SurveyComment IS NOT NULL AND SurveyComment <> ''" if with_text else ""
    return f"""
        SELECT *, sha256(SurveyComment) AS CommentId FROM {day}
        WHERE SurveyType = '{SURVEY}' AND InternalResponseFlag = 'False' AND DIM_DateId >= {CUTOFF}
              AND DIM_ProductMasterId IN ({PRODUCTS}) {text}"""


WORKLOAD_NAMES = config.workload_names(config.vocabulary("Workload"))
NULL_FIELDS = (
    "NULL::VARCHAR AS Segment, NULL::BIGINT AS SegmentNumber, NULL::DOUBLE AS Coverage,"
    " NULL::DOUBLE AS CumulativeCoverage, NULL::VARCHAR AS SentimentLabel,"
    " NULL::VARCHAR AS WorkloadLabel, NULL::VARCHAR AS SupportLabel, NULL::VARCHAR AS PlatformLabel"
)
SEGMENT_COLUMNS = (
    "Segment, SegmentNumber, Coverage, CumulativeCoverage, SentimentLabel, WorkloadLabel,"
    " SupportLabel, PlatformLabel"
)
ROW = [c for c in REPORT.names if c != "UserContext"]


def row_of(**given: str) -> str:
    """Select list of a report row without its context."""
    return ", ".join(f"{given.get(c, c)} AS {c}" for c in ROW)


def final(rows: str, fact: str) -> str:
    """A finished report from all its rows: names, ids, one dedupe, removals, context."""
    return f"""
        SELECT r.*, ctx.UserContext,
               CAST({case_map('r.WorkloadLabel', config.WORKLOAD_PRODUCT)} AS INT) AS Predicted_DIM_ProductMasterId,
               '{SURVEY}' AS SurveyType
        FROM (SELECT DISTINCT * REPLACE ({case_map('WorkloadLabel_original', config.WORKLOAD_DISPLAY)} AS WorkloadLabel)
              FROM ({rows})) r
        LEFT JOIN one_context ctx USING (FeedbackId)
        WHERE FeedbackId IN (SELECT FeedbackId FROM {fact})"""


CTES: dict[str, str] = {name: plain(name) for name in VIEWS}

CTES["dictionary"] = r"""
    SELECT DISTINCT word FROM (
        SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM benchmark)
    WHERE word <> ''"""

for _day in ("fact_survey", "day1", "day2"):
    CTES[f"reportable_{_day}"] = eligible(_day, False)
    CTES[f"eligible_{_day}"] = eligible(_day, True)
    CTES[f"stats_{_day}"] = f"""
        SELECT SurveyType, CommentId, min(SurveyComment) AS SurveyComment,
               min(DIM_DateId) AS FirstResponseDate, max(DIM_DateId) AS LastResponseDate,
               count(*) AS ResponseCount
        FROM eligible_{_day} GROUP BY SurveyType, CommentId"""
    CTES[f"flagged_{_day}"] = rf"""
        SELECT s.*, (length(SurveyComment) < 2 OR CommentId NOT IN (
            SELECT CommentId FROM (
                SELECT CommentId, unnest(string_split_regex(lower(SurveyComment), '[^\p{{L}}\p{{N}}_]+')) AS word
                FROM stats_{_day})
            WHERE word IN (SELECT word FROM dictionary))) AS IsNonresponse
        FROM stats_{_day} s"""
    CTES[f"answers_{_day}"] = f"SELECT * FROM flagged_{_day} WHERE NOT IsNonresponse"

CTES["known"] = f"""
    SELECT SurveyType, CommentId, SurveyComment, FirstResponseDate, LastResponseDate,
           NULL::BIGINT AS TokenCount,
           CASE WHEN length(SurveyComment) % 53 <> 0 AND length(SurveyComment) % 59 <> 0 THEN {DAY1} END AS ProcessingDate,
           CASE WHEN length(SurveyComment) % 53 <> 0 AND length(SurveyComment) % 59 <> 0
                     AND length(SurveyComment) % 7 <> 0 THEN {DAY1} END AS ReportingDate,
           length(SurveyComment) AS CharacterCount, ResponseCount
    FROM answers_day1"""

CTES["dim"] = """
    SELECT s.SurveyType, s.CommentId, s.SurveyComment, s.FirstResponseDate, s.LastResponseDate,
           k.TokenCount, k.ProcessingDate, k.ReportingDate,
           length(s.SurveyComment) AS CharacterCount, s.ResponseCount
    FROM answers_day2 s LEFT JOIN known k USING (SurveyType, CommentId)"""

CTES["completed"] = rf"""
    SELECT CommentId, SurveyComment,
           CASE WHEN length(SurveyComment) % 53 = 0 THEN 'error'
                WHEN length(SurveyComment) % 59 = 0 THEN 'unfinished' ELSE 'ok' END AS Status,
           CASE WHEN length(SurveyComment) % 53 <> 0 THEN
               array_to_string(list_transform(string_split_regex(SurveyComment, '{LINE_BREAKS}'),
                                              lambda s: '---' || s), chr(10)) END AS answer
    FROM answers_fact_survey"""

CTES["bare_lines"] = rf"""
    SELECT CommentId, SurveyComment, pos,
           trim(trim(trim(line, {BLANKS}), '-'), '"') AS Segment
    FROM (SELECT CommentId, SurveyComment, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
          FROM (SELECT CommentId, SurveyComment, string_split_regex(answer, '{LINE_BREAKS}') AS lines
                FROM completed WHERE Status = 'ok'))"""

CTES["plain_segments"] = """
    SELECT CommentId, SurveyComment, Segment,
           row_number() OVER (PARTITION BY CommentId ORDER BY min(pos)) - 1 AS SegmentNumber
    FROM bare_lines WHERE Segment <> '' GROUP BY CommentId, SurveyComment, Segment"""

CTES["comment_words"] = f"""
    SELECT CommentId, {words('SurveyComment')} AS whole FROM completed WHERE Status = 'ok'"""

CTES["covered"] = f"""
    SELECT p.CommentId, Segment, SegmentNumber,
           1 - (len(whole) - len(list_intersect(whole, {words('Segment')})))::DOUBLE / len(whole) AS Coverage
    FROM plain_segments p JOIN comment_words USING (CommentId)"""

CTES["segments"] = f"""
    SELECT *, sum(Coverage) OVER (PARTITION BY CommentId ORDER BY SegmentNumber
                                  ROWS UNBOUNDED PRECEDING) AS CumulativeCoverage,
           {DAY2} AS RunDateId
    FROM covered"""

CTES["labelled_raw"] = "SELECT *, " + ", ".join(
    f"{raw_label(t)} AS {t}Label" for t in LABEL_TYPES
) + " FROM segments"

for _t in LABEL_TYPES:
    CTES[f"snap_{_t}"] = snap_table(
        f"SELECT DISTINCT {_t}Label AS raw FROM labelled_raw", config.vocabulary(_t)
    )

CTES["snapped"] = f"""
    SELECT r.CommentId, Segment, SegmentNumber, Coverage, CumulativeCoverage, RunDateId,
           {', '.join(f's{i}.label AS {t}Label' for i, t in enumerate(LABEL_TYPES))}
    FROM labelled_raw r {' '.join(f'JOIN snap_{t} s{i} ON r.{t}Label = s{i}.raw' for i, t in enumerate(LABEL_TYPES))}"""

CTES["labelled"] = f"""
    SELECT * REPLACE ({case_map('WorkloadLabel', WORKLOAD_NAMES)} AS WorkloadLabel)
    FROM snapped
    WHERE CommentId NOT IN (SELECT CommentId FROM segments WHERE length(Segment) % 97 = 0)"""

CTES["context_values"] = "SELECT FeedbackId, coalesce(Value, '') AS UserContext FROM context"

CTES["context_items"] = """
    SELECT FeedbackId, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT FeedbackId, item
          FROM (SELECT FeedbackId, unnest(string_split(UserContext, ',')) AS item FROM context_values)
          WHERE item <> '')
    GROUP BY FeedbackId"""

CTES["one_context"] = """
    SELECT FeedbackId,
           CASE WHEN count(DISTINCT UserContext) < 2 THEN min(UserContext) ELSE coalesce(any_value(items), '') END AS UserContext
    FROM context_values LEFT JOIN context_items USING (FeedbackId) GROUP BY FeedbackId"""

for _day in ("fact_survey", "day1", "day2"):
    CTES[f"reportable_{_day}"] = eligible(_day, False)
    CTES[f"eligible_{_day}"] = eligible(_day, True)
    CTES[f"stats_{_day}"] = f"""
        SELECT SurveyType, CommentId, min(SurveyComment) AS SurveyComment,
               min(DIM_DateId) AS FirstResponseDate, max(DIM_DateId) AS LastResponseDate,
               count(*) AS ResponseCount
        FROM eligible_{_day} GROUP BY SurveyType, CommentId"""
    CTES[f"flagged_{_day}"] = rf"""
        SELECT s.*, (length(SurveyComment) < 2 OR CommentId NOT IN (
            SELECT CommentId FROM (
                SELECT CommentId, unnest(string_split_regex(lower(SurveyComment), '[^\p{{L}}\p{{N}}_]+')) AS word
                FROM stats_{_day})
            WHERE word IN (SELECT word FROM dictionary))) AS IsNonresponse
        FROM stats_{_day} s"""
    CTES[f"answers_{_day}"] = f"SELECT * FROM flagged_{_day} WHERE NOT IsNonresponse"

CTES["known"] = f"""
    SELECT SurveyType, CommentId, SurveyComment, FirstResponseDate, LastResponseDate,
           NULL::BIGINT AS TokenCount,
           CASE WHEN length(SurveyComment) % 53 <> 0 AND length(SurveyComment) % 59 <> 0 THEN {DAY1} END AS ProcessingDate,
           CASE WHEN length(SurveyComment) % 53 <> 0 AND length(SurveyComment) % 59 <> 0
                     AND length(SurveyComment) % 7 <> 0 THEN {DAY1} END AS ReportingDate,
           length(SurveyComment) AS CharacterCount, ResponseCount
    FROM answers_day1"""

CTES["dim"] = """
    SELECT s.SurveyType, s.CommentId, s.SurveyComment, s.FirstResponseDate, s.LastResponseDate,
           k.TokenCount, k.ProcessingDate, k.ReportingDate,
           length(s.SurveyComment) AS CharacterCount, s.ResponseCount
    FROM answers_day2 s LEFT JOIN known k USING (SurveyType, CommentId)"""

CTES["completed"] = rf"""
    SELECT CommentId, SurveyComment,
           CASE WHEN length(SurveyComment) % 53 = 0 THEN 'error'
                WHEN length(SurveyComment) % 59 = 0 THEN 'unfinished' ELSE 'ok' END AS Status,
           CASE WHEN length(SurveyComment) % 53 <> 0 THEN
               array_to_string(list_transform(string_split_regex(SurveyComment, '{LINE_BREAKS}'),
                                              lambda s: '---' || s), chr(10)) END AS answer
    FROM answers_fact_survey"""

CTES["bare_lines"] = rf"""
    SELECT CommentId, SurveyComment, pos,
           trim(trim(trim(line, {BLANKS}), '-'), '"') AS Segment
    FROM (SELECT CommentId, SurveyComment, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
          FROM (SELECT CommentId, SurveyComment, string_split_regex(answer, '{LINE_BREAKS}') AS lines
                FROM completed WHERE Status = 'ok'))"""

CTES["plain_segments"] = """
    SELECT CommentId, SurveyComment, Segment,
           row_number() OVER (PARTITION BY CommentId ORDER BY min(pos)) - 1 AS SegmentNumber
    FROM bare_lines WHERE Segment <> '' GROUP BY CommentId, SurveyComment, Segment"""

CTES["comment_words"] = f"""
    SELECT CommentId, {words('SurveyComment')} AS whole FROM completed WHERE Status = 'ok'"""

CTES["covered"] = f"""
    SELECT p.CommentId, Segment, SegmentNumber,
           1 - (len(whole) - len(list_intersect(whole, {words('Segment')})))::DOUBLE / len(whole) AS Coverage
    FROM plain_segments p JOIN comment_words USING (CommentId)"""

CTES["segments"] = f"""
    SELECT *, sum(Coverage) OVER (PARTITION BY CommentId ORDER BY SegmentNumber
                                  ROWS UNBOUNDED PRECEDING) AS CumulativeCoverage,
           {DAY2} AS RunDateId
    FROM covered"""

CTES["labelled_raw"] = "SELECT *, " + ", ".join(
    f"{raw_label(t)} AS {t}Label" for t in LABEL_TYPES
) + " FROM segments"

for _t in LABEL_TYPES:
    CTES[f"snap_{_t}"] = snap_table(
        f"SELECT DISTINCT {_t}Label AS raw FROM labelled_raw", config.vocabulary(_t)
    )

CTES["snapped"] = f"""
    SELECT r.CommentId, Segment, SegmentNumber, Coverage, CumulativeCoverage, RunDateId,
           {', '.join(f's{i}.label AS {t}Label' for i, t in enumerate(LABEL_TYPES))}
    FROM labelled_raw r {' '.join(f'JOIN snap_{t} s{i} ON r.{t}Label = s{i}.raw' for i, t in enumerate(LABEL_TYPES))}"""

CTES["labelled"] = f"""
    SELECT * REPLACE ({case_map('WorkloadLabel', WORKLOAD_NAMES)} AS WorkloadLabel)
    FROM snapped
    WHERE CommentId NOT IN (SELECT CommentId FROM segments WHERE length(Segment) % 97 = 0)"""

CTES["one_context"] = """
    SELECT FeedbackId,
           CASE WHEN count(DISTINCT UserContext) < 2 THEN min(UserContext)
                ELSE coalesce((SELECT string_agg(DISTINCT item, ',' ORDER BY item)
                               FROM (SELECT unnest(string_split(string_agg(UserContext, ','), ',')) AS item) WHERE item <> ''), '')
           END AS UserContext
    FROM (SELECT FeedbackId, array_to_string(string_split(coalesce(Value, ''), ','), ',') AS UserContext
          FROM context) GROUP BY FeedbackId"""

for _day in ("day1", "day2"):
    CTES[f"empty_{_day}"] = f"""
        SELECT *, {NULL_FIELDS}, 'Empty' AS ReportingType, NULL AS WorkloadLabel_original
        FROM reportable_{_day} WHERE SurveyComment IS NULL OR SurveyComment = ''"""
    CTES[f"silent_{_day}"] = f"""
        SELECT *, {NULL_FIELDS}, 'Nonresponse' AS ReportingType, NULL AS WorkloadLabel_original
        FROM reportable_{_day}
        WHERE CommentId IN (SELECT CommentId FROM flagged_{_day} WHERE IsNonresponse)"""

CTES["current_day1"] = f"""
    SELECT {row_of(ReportingType="'Report'", WorkloadLabel_original='WorkloadLabel')}
    FROM reportable_day1 JOIN labelled USING (CommentId)
    WHERE CommentId IN (SELECT CommentId FROM known WHERE ProcessingDate IS NOT NULL)"""

CTES["prior_report"] = final(
    f"""SELECT * FROM current_day1
        UNION ALL SELECT {row_of()} FROM silent_day1
        UNION ALL SELECT {row_of()} FROM empty_day1""",
    "reportable_day1",
)

CTES["today"] = """
    SELECT * FROM labelled
    WHERE CommentId IN (SELECT CommentId FROM dim WHERE ProcessingDate IS NULL)"""

CTES["dim_done"] = f"""
    SELECT * REPLACE (CASE WHEN CommentId IN (SELECT CommentId FROM today)
                           THEN {DAY2} ELSE ProcessingDate END AS ProcessingDate)
    FROM dim"""

CTES["processed"] = """
    SELECT * FROM reportable_day2
    WHERE CommentId IN (SELECT CommentId FROM dim_done WHERE ProcessingDate IS NOT NULL)"""

CTES["current"] = f"""
    SELECT {row_of(ReportingType="'Report'", WorkloadLabel_original='WorkloadLabel')}
    FROM processed JOIN today USING (CommentId)"""

CTES["restated"] = f"""
    SELECT {row_of(DIM_DateId='f.DIM_DateId', DIM_ProductMasterId='f.DIM_ProductMasterId',
                   FeedbackId='f.FeedbackId', Score='f.Score', CommentId='p.CommentId',
                   SurveyComment='p.SurveyComment')}, UserContext
    FROM reportable_day2 f JOIN prior_report p ON f.FeedbackId = p.FeedbackId"""

CTES["total"] = f"""
    SELECT DISTINCT * FROM (
        SELECT {row_of()}, NULL AS UserContext FROM current
        UNION ALL
        SELECT {row_of()}, UserContext FROM restated r
        WHERE NOT EXISTS (SELECT 1 FROM current c WHERE c.FeedbackId = r.FeedbackId
                          AND c.DIM_ProductMasterId = r.DIM_ProductMasterId))"""

CTES["repeats"] = """
    SELECT * FROM processed WHERE FeedbackId NOT IN (SELECT FeedbackId FROM total)"""

CTES["donors"] = """
    SELECT CommentId, FeedbackId AS donor FROM (
        SELECT CommentId, FeedbackId,
               row_number() OVER (PARTITION BY CommentId ORDER BY DIM_DateId DESC, FeedbackId) AS place
        FROM (SELECT DISTINCT CommentId, FeedbackId, DIM_DateId FROM total))
    WHERE place = 1"""

CTES["inherited"] = f"""
    SELECT DISTINCT r.DIM_DateId, r.DIM_ProductMasterId, r.FeedbackId, r.CommentId, r.SurveyComment,
           {', '.join('t.' + c.strip() for c in SEGMENT_COLUMNS.split(','))},
           r.Score, t.ReportingType, t.WorkloadLabel_original
    FROM repeats r JOIN donors d USING (CommentId)
    JOIN total t ON t.CommentId = d.CommentId AND t.FeedbackId = d.donor"""

CTES["final_report"] = final(
    f"""SELECT {row_of()} FROM total
        UNION ALL SELECT {row_of()} FROM inherited
        UNION ALL SELECT {row_of()} FROM silent_day2
        UNION ALL SELECT {row_of()} FROM empty_day2""",
    "reportable_day2",
)


def counts(source: str, day: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {day} AS DIM_DateId, '{t}Label' AS LabelType,"
        f" coalesce({t}Label, 'Not Labeled') AS LabelValue,"
        f" count(DISTINCT FeedbackId) AS DistinctResponseCount"
        f" FROM {source} WHERE ReportingType = 'Report' GROUP BY 3"
        for t in LABEL_TYPES
    )


CTES["qc_before"] = counts("prior_report", DAY1)
CTES["qc_now"] = counts("final_report", DAY2)


def complete(sql: str, extra: dict[str, str] | None = None) -> str:
    """The query with every common table expression it needs, in order."""
    extra = extra or {}
    needed: list[str] = []
    pool = {**CTES, **extra}

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in pool:
            if name in path or not re.search(rf"(FROM|JOIN|IN|,)\s*\(?\s*{name}\b", text):
                continue
            if name not in needed:
                visit(pool[name], (*path, name))
                if name not in needed:
                    needed.append(name)

    visit(sql, ())
    if not needed:
        return sql
    head = ",\n".join(f"{n} AS MATERIALIZED ({pool[n]})" for n in needed)
    return f"WITH {head}\n{sql}"
