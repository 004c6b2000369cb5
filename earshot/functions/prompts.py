"""Prompt texts and prompt keys as columns.

A template names the row's own values in braces. The key of a prompt is a digest of the template
and of those values, with the comment's id in place of its text: the long text of a prompt is
only built for prompts that really have to be sent.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot import config

SEGMENT_TEMPLATE = "{SurveyComment}"
REASON_CLAUSE = "\nWeigh this remark on an earlier answer: {Justification}"
_NAMED = re.compile(r"\{(\w+)\}")


def chat_messages(system: Column, user: Column) -> Column:
    """The two messages of a call, instruction first."""

    def message(role: str, content: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"), content.alias("content"), F.lit(role).alias("name")
        )

    return F.array(message("system", system), message("user", user))


def system_prompt(stage: str, label_type: str) -> Column:
    return F.lit(config.SYSTEM_PROMPTS[(stage, label_type)])


def _listed(text: str) -> str:
    return "; ".join(text.split("\n")[1:-1])


def label_template(label_type: str) -> str:
    """Text that asks for a label; sentiment is judged by the segment alone."""
    text = f"Choose one of: {_listed(config.VOCABULARY_TEXT[label_type])}\nSegment: {{Segment}}"
    if label_type in config.EXPLANATION_TEXT:
        text = f"The labels mean: {_listed(config.EXPLANATION_TEXT[label_type])}\n{text}"
    if label_type in config.SEES_COMMENT:
        text += "\nWhole comment: {SurveyComment}"
    return text


def validation_template(label_type: str) -> str:
    """Text that asks whether a label is right."""
    text = f"Segment: {{Segment}}\nLabel: {{{label_type}Label}}\nAgree or Disagree?"
    if label_type in config.EXPLANATION_TEXT:
        means = _listed(config.EXPLANATION_TEXT[label_type])
        text = f"The labels mean: {means}\nWhole comment: {{SurveyComment}}\n{text}"
    return text


def takes_reason(label_type: str, iteration: int) -> bool:
    """The second round shows the validation's reason, except for support labels."""
    return iteration == 1 and label_type in config.TAKES_JUSTIFICATION


def _has_reason() -> Column:
    return F.length("Justification") > 1


def rendered(template: str, with_reason: bool = False) -> Column:
    """The template with the row's values filled in."""
    pieces = [
        F.col(p) if i % 2 else F.lit(p) for i, p in enumerate(_NAMED.split(template)) if p
    ]
    if with_reason:
        pieces.append(F.when(_has_reason(), rendered(REASON_CLAUSE)).otherwise(""))
    return F.concat(*pieces)


def template_digest(stage: str, label_type: str, template: str, with_reason: bool = False) -> str:
    texts = [config.SYSTEM_PROMPTS[(stage, label_type)], template, REASON_CLAUSE * with_reason]
    return hashlib.md5("\n".join(texts).encode()).hexdigest()


def prompt_id(stage: str, label_type: str, template: str, with_reason: bool = False) -> Column:
    """Key of a prompt; equal prompts have equal keys and share one completion."""
    values = ["CommentId" if n == "SurveyComment" else n for n in _NAMED.findall(template)]
    parts = [F.lit(template_digest(stage, label_type, template, with_reason)), *map(F.col, values)]
    if with_reason:
        parts.append(F.when(_has_reason(), F.col("Justification")))
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
