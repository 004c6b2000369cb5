"""Offline answers to prompts, by rule from the row's own values, in place of a remote service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot import config
from earshot.functions.text import LINE_BREAKS


def _answer(content: Column, failed: Column, cut: Column) -> dict[str, Column]:
    none = F.lit(None)
    return {
        "content": F.when(~failed, F.array(content)),
        "finish_reason": F.when(
            ~failed, F.array(F.when(cut, "content_filter").otherwise("stop"))
        ),
        "error": F.when(
            failed, F.struct(F.lit("429").alias("code"), F.lit("by rule").alias("message"))
        ),
        "id": F.concat(F.lit("rule-"), F.substring("PromptId", 1, 12)),
        "created": none.cast("long"),
    }


def _distinct_prompts(keyed: DataFrame, carry: Sequence[str]) -> DataFrame:
    return keyed.groupBy("PromptId").agg(*[F.first(c).alias(c) for c in carry])


def _completions(prompts: DataFrame, answer: dict[str, Column]) -> DataFrame:
    return prompts.select("PromptId", *[c.alias(n) for n, c in answer.items()])


def rule_segments(keyed: DataFrame, error_every: int = 53, cut_every: int = 59) -> DataFrame:
    """Completions that quote every line of the comment behind three dashes."""
    prompts = _distinct_prompts(keyed, ["SurveyComment"])
    size = F.length("SurveyComment")
    lines = F.transform(
        F.split("SurveyComment", LINE_BREAKS), lambda s: F.concat(F.lit("---"), s)
    )
    return _completions(
        prompts,
        _answer(F.concat_ws("\n", lines), size % error_every == 0, size % cut_every == 0),
    )


def noisy_label(label_type: str, shift: int = 0) -> Column:
    """A vocabulary entry picked by the segment's length, often misspelt."""
    entries = config.vocabulary(label_type)
    size = F.length("Segment")
    picked = F.get(
        F.array(*[F.lit(e) for e in entries]),
        F.pmod(size + shift, F.lit(len(entries))).cast("int"),
    )
    return (
        F.when(size % 3 == 0, F.concat(F.lower(picked), F.lit(".")))
        .when(size % 3 == 1, F.replace(picked, F.lit("e"), F.lit("")))
        .otherwise(picked)
    )


def rule_labels(
    keyed: DataFrame, label_type: str, iteration: int = 0, error_every: int = 97
) -> DataFrame:
    """Completions that answer with :func:`noisy_label`; round 1 answers differently."""
    # Answered before prompts are made distinct: an answer is shorter than its segment.
    told = keyed.select(
        "PromptId", noisy_label(label_type, iteration).alias("_told"),
        (F.length("Segment") % error_every == 0).alias("_failed"),
    )
    prompts = _distinct_prompts(told, ["_told", "_failed"])
    return _completions(prompts, _answer(F.col("_told"), F.col("_failed"), F.lit(False)))


def validation_text(label: Column) -> Column:
    """A validation answer picked by the segment's length: plain, reasoned or contradictory."""
    size = F.length("Segment")
    return (
        F.when(size % 5 == 0, F.lit("Agree"))
        .when(size % 5 == 1, F.concat(F.lit("disagree\nThe label "), label, F.lit(" is wrong.")))
        .when(size % 5 == 2, F.lit("Disagree. No sign of it"))
        .when(
            size % 5 == 3,
            F.concat(F.lit("Disagree\nI find the label "), label, F.lit(" is accurate.")),
        )
        .otherwise(F.lit("Agree.\nIt fits."))
    )


def rule_validations(keyed: DataFrame, label_type: str, error_every: int = 89) -> DataFrame:
    """Completions that answer with :func:`validation_text`."""
    column = f"{label_type}Label"
    prompts = _distinct_prompts(keyed, ["Segment", column])
    failed = F.length("Segment") % error_every == 0
    return _completions(
        prompts, _answer(validation_text(F.col(column)), failed, F.lit(False))
    )


def rule_answer(asked: DataFrame, stage: str, label_type: str, iteration: int) -> DataFrame:
    """Answer the daily job's prompts by rule."""
    if stage == "segment":
        return rule_segments(asked)
    if stage == "assign":
        return rule_labels(asked, label_type, iteration)
    return rule_validations(asked, label_type)
