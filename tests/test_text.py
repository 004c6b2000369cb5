"""Text columns against plain Python."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot import config
from earshot.functions import text
from earshot.functions.dates import date_id, parsed_date
from earshot.operators import completions, labels, segments

PIECES = st.lists(
    st.sampled_from(["a", "B c", " ", "-", "--x--", '"q"', "\n", "\r\n", " ", "\t", " ", "?", "!", ".", "'", "é", ""]),
    max_size=12,
).map("".join)


def values(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.select("i", column(F.col("t")).alias("v")).orderBy("i").select("v").collect()]


def clean_python(answer):
    bare = [s.strip().strip("-").strip('"') for s in answer.splitlines()]
    return [s for s in dict.fromkeys(bare) if s]


def words_python(t):
    return list(dict.fromkeys(re.split(r"""[ ,.;:"']+""", re.sub(r"[!?\-]+", "", t))))


@settings(max_examples=5, deadline=None)
@given(st.lists(PIECES, min_size=20, max_size=60))
def test_against_python(spark, texts):
    assert values(spark, texts, text.clean_segments) == [clean_python(t) for t in texts]
    assert values(spark, texts, text.word_set) == [words_python(t) for t in texts]
    tokens = [list(dict.fromkeys(re.findall(r"\w+", t.lower()))) for t in texts]
    assert values(spark, texts, text.lower_tokens) == tokens


def test_coverage_lies_in_unit_range_and_may_add_up_to_more(spark):
    rows = spark.createDataFrame([("c", "red car red bus", ["---red car\n---red bus\n---red bus"])], "CommentId string, SurveyComment string, content array<string>")
    out = segments.segment_comments(rows, 20240101).orderBy("SegmentNumber").collect()
    assert [(r["Segment"], r["SegmentNumber"]) for r in out] == [("red car", 0), ("red bus", 1)]
    assert all(0 <= r["Coverage"] <= 1 for r in out)
    assert out[-1]["CumulativeCoverage"] > 1


def test_empty_answer_gives_no_segment(spark):
    rows = spark.createDataFrame([("c", "text", ["---\n--"]), ("d", "text", [])], "CommentId string, SurveyComment string, content array<string>")
    assert segments.segment_comments(rows, 20240101).count() == 0


def test_closest_label(spark):
    entries = ["Positive", "Mixed", "Not Applicable"]
    raws = ["positive!", "This is Mixed, surely", "Not  applicabel", "zzzz", "", None]
    got = values(spark, raws, lambda c: text.closest_label(c, entries))
    assert got[:3] == ["Positive", "Mixed", "Not Applicable"]
    assert got[3] in entries and got[4] in entries and got[5] is None
    assert values(spark, raws, lambda c: text.closest_label(c, entries, floor=0.5))[3] is None


def test_closest_label_ties_go_to_the_earlier_entry(spark):
    assert values(spark, ["abX"], lambda c: text.closest_label(c, ["abc", "abd"])) == ["abc"]


def test_parse_consensus(spark):
    answers = {
        "Agree": ("Agree", " "),
        "Disagree. Wrong area": ("Disagree", "Wrong area"),
        "Disagree.No": ("Disagree", "No"),
        "agree\nit fits\nwell": ("Agree", "it fits\nwell"),
        "Disagree\n": ("Disagree", ""),
    }
    got = values(spark, list(answers), labels.parse_consensus)
    assert [(v["Consensus"], v["Justification"]) for v in got] == list(answers.values())
    assert values(spark, [None], labels.parse_consensus) == [None]


def test_contradiction_needs_a_disagree_and_a_pattern(spark):
    cases = [
        ("Disagree\nThis is appropriate for the segment.", "Agree"),
        ("Disagree\nI agree with the label", "Agree"),
        ("Disagree\nIt is inaccurate", "Disagree"),
        ("Agree\nthe label X is accurate", "Agree"),
    ]
    got = values(spark, [c for c, _ in cases], lambda c: labels.contradiction_override(labels.parse_consensus(c)))
    assert [v["Consensus"] for v in got] == [e for _, e in cases]
    assert got[0]["Justification"] == config.CONTRADICTION_NOTE and got[3]["Justification"] != config.CONTRADICTION_NOTE


def test_dates(spark):
    texts = ["20240131", "2024-01-31", "2024-1-31", "20241301", "31.01.2024", ""]
    got = [str(v) if v else None for v in values(spark, texts, parsed_date)]
    assert got == ["2024-01-31", "2024-01-31", None, None, None, None]
    assert date_id("2024-01-31") == date_id("20240131") == 20240131
    import datetime as dt

    assert date_id(None, today=dt.date(2024, 2, 1)) == 20240201


def test_triage_and_all_or_nothing(spark):
    err = ("429", "x")
    rows = spark.createDataFrame(
        [
            ("a", 0, ["x"], ["stop"], None), ("a", 1, None, None, err), ("b", 0, ["x"], ["length"], None),
            ("c", 0, ["x"], ["content_filter"], None), ("d", 0, None, None, None), ("e", 0, ["x"], None, None),
        ],
        "CommentId string, SegmentNumber int, content array<string>, finish_reason array<string>, error struct<code:string,message:string>",
    )
    out = completions.triage(rows)
    status = {(r[0], r[1]): r["Status"] for r in out.collect()}
    assert status == {("a", 0): "ok", ("a", 1): "error", ("b", 0): "ok", ("c", 0): "unfinished", ("d", 0): "missing", ("e", 0): "ok"}
    assert {r["CommentId"] for r in completions.good_rows(out).collect()} == {"b", "e"}
    assert {r["CommentId"] for r in completions.quarantine_rows(out, 1).collect()} == {"a", "c", "d"}


def test_prompts(spark):
    rows = spark.createDataFrame([("c", "whole text", "part", "Because.")], "CommentId string, SurveyComment string, Segment string, Justification string")
    user = lambda kind, i: completions.label_messages(rows, kind, i).select("Message").head()[0]
    for kind in ("Sentiment", "Workload", "Support", "Platform"):
        system, asked = user(kind, 0)
        assert system["role"] == system["name"] == "system" and asked["role"] == "user"
        assert "part" in asked["content"]
        assert ("whole text" in asked["content"]) == (kind != "Sentiment")
        assert ("Because." in user(kind, 1)[1]["content"]) == (kind != "Support")
        assert "Because." not in asked["content"]
    assert completions.segment_messages(rows).head()["Message"][1]["content"] == "whole text"


def test_equal_prompts_share_a_key(spark):
    rows = spark.createDataFrame([("c", "part"), ("d", "part")], "CommentId string, Segment string")
    ids = lambda kind: [r["PromptId"] for r in completions.label_keys(rows, kind).collect()]
    assert len(set(ids("Sentiment"))) == 1 and len(set(ids("Workload"))) == 2


def test_relabel_round(spark):
    rows = spark.createDataFrame(
        [("a", 0, "Old", ("Agree", "")), ("a", 1, "Old", ("Disagree", "")), ("a", 2, "Old", None), ("b", 0, "Old", ("Agree", "")), ("b", 1, "Old", ("Disagree", ""))],
        "CommentId string, SegmentNumber int, SentimentLabel string, SentimentLabel_validation struct<Consensus:string,Justification:string>",
    )
    second = spark.createDataFrame([("a", 1, "New"), ("a", 2, "New"), ("a", 0, "New")], "CommentId string, SegmentNumber int, SentimentLabel string")
    got = {(r["CommentId"], r["SegmentNumber"]): (r["SentimentLabel"], r["Sentiment_iteration"], r["SentimentLabel_iteration0"]) for r in labels.relabel_round(rows, second, "Sentiment").collect()}
    # comment b has a segment that nobody labelled again, so all of it waits
    assert got == {("a", 0): ("Old", 0, "Old"), ("a", 1): ("New", 1, "Old"), ("a", 2): ("New", 1, "Old")}


def test_config_lists():
    for kind in config.VOCABULARY_TEXT:
        entries = config.vocabulary(kind)
        assert entries[-1] == config.NOT_APPLICABLE and len(set(entries)) == len(entries) and all(entries)
    names = config.workload_names(config.vocabulary("Workload"))
    assert set(names.values()) <= set(config.WORKLOAD_DISPLAY)
    assert set(config.WORKLOAD_DISPLAY.values()) == set(config.WORKLOAD_PRODUCT)


def test_coverage_of_answers_that_do_not_quote(spark):
    """Words an answer makes up count for nothing, as in the plain definition."""
    comment, answer = "red car, blue bus?", "red lorry\nblue bus\ngreen -- van\nred"
    rows = spark.createDataFrame([("c", comment, [answer])], "CommentId string, SurveyComment string, content array<string>")
    got = {r["Segment"]: round(r["Coverage"], 9) for r in segments.explode_segments(rows).collect()}
    whole = set(words_python(comment))
    want = {s: round(1 - len(whole - set(words_python(s))) / len(whole), 9) for s in clean_python(answer)}
    assert got == want
