"""Vocabularies, prompt texts and maps. All are closed lists of a few dozen entries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# --- closed lists for an invented product, the orchard planner "Grove" ---------------------

VENDOR_PREFIX = "Grove "
NOT_APPLICABLE = "Not Applicable"
GENERIC_WORKLOAD = "Grove Overall"

# The product's areas: stored label, product id, name in reports, meaning. All lists and maps of areas come from here.
AREAS = [
    ("Grove Planting Plan", 10, "Planting", "which trees go where, and when"),
    ("Weather Watch", 11, "Weather", "forecasts, frost warnings and gauges"),
    ("Grove Irrigation", 12, "Water", "valves, schedules and water use"),
    ("Harvest Crew", 13, "Crew", "shifts, pickers and their hours"),
    ("Grove Market Desk", 14, "Market", "orders, buyers and prices of fruit"),
    ("Pest Diary", 15, "Pests", "sightings, traps and treatments"),
]
_OVERALL = (GENERIC_WORKLOAD, 16, "Overall", "the product as a whole")

# (label, meaning) of the other kinds with meanings.
_MEANINGS = {
    "Support": [
        ("Phone Line", "calls with the help desk"),
        ("Field Visit", "a technician who came by"),
        ("Waiting Time", "how long an answer took"),
        ("Guides", "written or filmed instructions"),
        ("Callback", "what happened after a case was closed"),
    ],
    "Platform": [
        ("Offline Work", "use without a network"),
        ("Sensor Pairing", "connecting gauges, valves and scales"),
        ("Maps", "plots, rows and satellite pictures"),
        ("Ease of Use", "how quickly one finds one's way"),
        ("Subscription", "plans, fees and renewals"),
        ("Languages", "translations and units"),
        ("Data Export", "getting records out again"),
        ("Crashes", "the product stops or loses entries"),
    ],
    "Workload": [(label, meaning) for label, _, _, meaning in AREAS],
}
_MOODS = ["Positive", "Neutral", "Negative", "Mixed"]


def _lines(entries: list[str]) -> str:
    return "\n" + "\n".join([*entries, ""])


VOCABULARY_TEXT = {"Sentiment": _lines([*_MOODS, NOT_APPLICABLE])} | {
    kind: _lines([*(label for label, _ in rows), NOT_APPLICABLE]) for kind, rows in _MEANINGS.items()
}
EXPLANATION_TEXT = {
    kind: _lines([f"{label}: {meaning}" for label, meaning in [*rows, (NOT_APPLICABLE, "nothing of this kind is mentioned")]])
    for kind, rows in _MEANINGS.items()
}

CONSENSUS_VALUES = ["Disagree", "Agree"]

# Product ids that take part, keyed by the id used in the survey tool.
PRODUCT_MAP = {100 + product: product for product in range(10, 17)}

# Label as stored by the labelling stage -> name shown in the report -> product id.
WORKLOAD_DISPLAY = {label.removeprefix(VENDOR_PREFIX): shown for label, _, shown, _ in AREAS} | {_OVERALL[0]: _OVERALL[2]}
WORKLOAD_PRODUCT = {shown: product for _, product, shown, _ in [*AREAS, _OVERALL]}

# Justifications that contradict a "Disagree", as LIKE patterns, and the note
# that replaces them.
CONTRADICTION_PATTERNS = [
    "%is appropriate for % segment%",
    "%is accurate for % segment%",
    "%I agree with % label%",
    "%the label % is accurate%",
]
CONTRADICTION_NOTE = "Heuristic detected contradiction, override to Agree."

# --- prompt texts ------------------------------------------------------------------------

SEGMENT_SYSTEM = (
    "You split one survey comment into its separate topics. Quote the comment word for word, "
    "one topic per line, each line starting with three dashes. Add nothing of your own."
)

_ASSIGN = (
    "You read one segment of a survey comment and choose the single best {what} label "
    "from a closed list. Answer with the label only."
)
_CHECK = (
    "You check whether the {what} label given to a segment of a survey comment is right. "
    "Answer Agree or Disagree on the first line and give your reason on the second."
)

SYSTEM_PROMPTS = {
    ("segment", "All"): SEGMENT_SYSTEM,
    ("assign", "Sentiment"): _ASSIGN.format(what="sentiment"),
    ("assign", "Workload"): _ASSIGN.format(what="product area"),
    ("assign", "Support"): _ASSIGN.format(what="support"),
    ("assign", "Platform"): _ASSIGN.format(what="platform quality"),
    ("validate", "Sentiment"): _CHECK.format(what="sentiment"),
    ("validate", "Workload"): _CHECK.format(what="product area"),
    ("validate", "Platform"): _CHECK.format(what="platform quality"),
}

# Label types whose prompt shows the whole comment, and those that take the justification
# of an earlier validation in the second round.
SEES_COMMENT = {"Workload", "Support", "Platform"}
TAKES_JUSTIFICATION = {"Sentiment", "Workload", "Platform"}


def vocabulary(label_type: str, extra: tuple[str, ...] = ()) -> list[str]:
    """Entries of a closed list: the lines of its text without the first and the last."""
    return VOCABULARY_TEXT[label_type].split("\n")[1:-1] + list(extra)


def vocabulary_frame(spark: SparkSession) -> DataFrame:
    """(LabelType, Label, Rank) of every closed list."""
    rows = [
        (kind, label, rank)
        for kind in VOCABULARY_TEXT
        for rank, label in enumerate(vocabulary(kind))
    ]
    return spark.createDataFrame(rows, "LabelType string, Label string, Rank int")


def system_prompt_frame(spark: SparkSession) -> DataFrame:
    """(Stage, LabelType, Instruction), one row per kind of call."""
    rows = [(stage, kind, text) for (stage, kind), text in SYSTEM_PROMPTS.items()]
    return spark.createDataFrame(rows, "Stage string, LabelType string, Instruction string")


def product_ids() -> list[int]:
    return sorted(PRODUCT_MAP.values())


def workload_names(entries: list[str]) -> dict[str, str]:
    """Map stored labels to plain names: vendor prefix off, "Not Applicable" made generic."""
    return {
        e: GENERIC_WORKLOAD if e == NOT_APPLICABLE else e
        if e == GENERIC_WORKLOAD
        else re.sub(re.escape(VENDOR_PREFIX), "", e)
        for e in entries
    }
