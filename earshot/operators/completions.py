"""Attaching completions to prompts, and sorting good answers from bad ones.

The remote call itself is outside this library: completions are a table keyed by a digest of the
prompt. Prompts without one are listed as pending; whatever answers them appends to the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.prompts import (
    SEGMENT_TEMPLATE,
    chat_messages,
    label_template,
    prompt_id,
    rendered,
    system_prompt,
    takes_reason,
    validation_template,
)
from earshot.operators.skew import skew_join
from earshot.schemas import COMPLETIONS

# Finish reasons that count as finished.
FINISHED = ["stop", "length"]

# What an answered row carries besides its own columns.
ANSWER_COLUMNS = ["PromptId", "content", "finish_reason", "error", "id", "created", "Status"]


# -- prompts


def _keyed(rows: DataFrame, stage: str, kind: str, template: str, reason: bool) -> DataFrame:
    return rows.withColumn("PromptId", prompt_id(stage, kind, template, reason))


def _asked(rows: DataFrame, stage: str, kind: str, template: str, reason: bool) -> DataFrame:
    text = chat_messages(system_prompt(stage, kind), rendered(template, reason))
    return rows.withColumn("Message", text)


def segment_keys(comments: DataFrame) -> DataFrame:
    """Add the key of the prompt that asks for a comment's segments."""
    return _keyed(comments, "segment", "All", SEGMENT_TEMPLATE, False)


def segment_messages(comments: DataFrame) -> DataFrame:
    """Add the messages that ask for a comment's segments; reads ``SurveyComment``."""
    return _asked(comments, "segment", "All", SEGMENT_TEMPLATE, False)


def label_keys(segments: DataFrame, label_type: str, iteration: int = 0) -> DataFrame:
    """Add the key of the prompt that asks for a segment's label; needs no comment text."""
    reason = takes_reason(label_type, iteration)
    return _keyed(segments, "assign", label_type, label_template(label_type), reason)


def label_messages(segments: DataFrame, label_type: str, iteration: int = 0) -> DataFrame:
    """Add the messages that ask for a segment's label.

    Reads ``SurveyComment``, and ``Justification`` in round 1.
    """
    reason = takes_reason(label_type, iteration)
    return _asked(segments, "assign", label_type, label_template(label_type), reason)


def validation_keys(labelled: DataFrame, label_type: str) -> DataFrame:
    """Add the key of the prompt that asks whether a segment's label is right."""
    return _keyed(labelled, "validate", label_type, validation_template(label_type), False)


def validation_messages(labelled: DataFrame, label_type: str) -> DataFrame:
    """Add the messages that ask whether a segment's label is right."""
    return _asked(labelled, "validate", label_type, validation_template(label_type), False)


# Rows of one frame that ask for labels of several types: the template follows from the type, and a comment's text joins once for all.


def _per_kind(kinds: Sequence[str], made: Callable[[str], Column]) -> Column:
    out = None
    for kind in kinds:
        out = F.when(F.col("LabelType") == kind, made(kind)) if out is None else out.when(F.col("LabelType") == kind, made(kind))
    return out


def per_label_type(rows: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Every row once for each label type."""
    return rows.withColumn("LabelType", F.explode(F.array(*[F.lit(k) for k in kinds])))


def keys_by_type(rows: DataFrame, stage: str, kinds: Sequence[str], iteration: int = 0) -> DataFrame:
    """Add each row's prompt key by its ``LabelType``; ``stage`` is assign or validate."""
    key = lambda kind: prompt_id(stage, kind, _template(stage, kind), stage == "assign" and takes_reason(kind, iteration))
    return rows.withColumn("PromptId", _per_kind(kinds, key))


def messages_by_type(rows: DataFrame, stage: str, kinds: Sequence[str], iteration: int = 0) -> DataFrame:
    """Add each row's messages by its ``LabelType``; reads the columns that the templates of the types name."""
    text = lambda kind: chat_messages(system_prompt(stage, kind), rendered(_template(stage, kind), stage == "assign" and takes_reason(kind, iteration)))
    return rows.withColumn("Message", _per_kind(kinds, text))


def _template(stage: str, kind: str) -> str:
    return label_template(kind) if stage == "assign" else validation_template(kind)


# -- completions


def complete_messages(
    keyed: DataFrame, completions: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Attach content, finish reasons, error, id and creation time to every keyed row.

    The join is on the prompt's key, so neither message texts nor comment texts travel. One
    prompt may stand for a great many rows (short segments repeat); ``hot`` names such prompts.
    Rows without a completion keep nulls and are triaged as missing.
    """
    return skew_join(keyed, completions, ["PromptId"], "left", _row_ids(keyed), hot)


def pending_prompts(keyed: DataFrame, completions: DataFrame) -> DataFrame:
    """One row per prompt without a usable answer; add the comment text to build its messages.

    Prompts whose answers failed or were cut off are asked again.
    """
    once = keyed.dropDuplicates(["PromptId"])
    usable = triage(completions).filter("Status = 'ok'")
    return once.join(usable.select("PromptId").distinct(), "PromptId", "left_anti")


def best_answers(completions: DataFrame, newest: Column) -> DataFrame:
    """One completion per prompt: a usable one if there is any, of those the newest."""
    body = [f for f in COMPLETIONS.names if f != "PromptId"]
    ranked = triage(completions).withColumn("_order", F.struct((F.col("Status") == "ok").alias("ok"), newest.alias("at")))
    best = ranked.groupBy("PromptId").agg(F.max_by(F.struct(*body), F.col("_order")).alias("_best"))
    return best.select("PromptId", *[F.col("_best")[b].alias(b) for b in body])


def _row_ids(df: DataFrame) -> list[str]:
    return [c for c in ("CommentId", "SegmentNumber", "LabelType") if c in df.columns]


# -- triage


def triage(completed: DataFrame) -> DataFrame:
    """Add Status: error, unfinished, missing or ok.

    An error has no content but an error; unfinished means the first finish reason is neither
    stop nor length; missing has no content, no error and no finish reason.
    """
    reason = F.get("finish_reason", F.lit(0))
    no_content = F.col("content").isNull()
    return completed.withColumn(
        "Status",
        F.when(no_content & F.col("error").isNotNull(), "error")
        .when(reason.isNotNull() & ~reason.isin(FINISHED), "unfinished")
        .when(no_content, "missing")
        .otherwise("ok"),
    )


def good_rows(triaged: DataFrame, by: Sequence[str] = ("CommentId",)) -> DataFrame:
    """Rows of comments all of whose rows are good: a comment counts as a whole or not at all.

    A group is the rows of one comment (the segments of one text; with LabelType in ``by``, those of one type), so a window over it
    is small and spares a second pass over the completions.
    """
    comment = Window.partitionBy(*by)
    bad = F.count_if(F.col("Status") != "ok").over(comment)
    return triaged.withColumn("_bad", bad).filter(F.col("_bad") == 0).drop("_bad")


def quarantine_rows(triaged: DataFrame, run_date: int) -> DataFrame:
    """The bad rows themselves, stamped with the run date."""
    return triaged.filter(F.col("Status") != "ok").withColumn("RunDateId", F.lit(run_date))


def single_label(completed: DataFrame, label_type: str) -> DataFrame:
    """First answer as the label column."""
    return completed.withColumn(f"{label_type}Label", F.get("content", F.lit(0))).drop(
        *ANSWER_COLUMNS
    )
