"""The daily job: intake, segmentation, labelling, validation, relabelling, report, checks.

Each stage reads tables and writes tables, so lineage ends at every stage, a lost executor
costs a stage's tasks and not the run, and a stage can be repeated for its day. The comment
dimension is kept as two tables: texts, which are added once and stay, and the narrow work state, which is
what later stages rewrite.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot import config
from earshot.operators import intake as arrivals
from earshot.operators import comments, completions, fuzzy, labels, quality, report, segments, shape
from earshot.operators.skew import hot_keys
from earshot.schemas import (
    ANSWERS, COMMENT_COUNTS, COMMENT_DIM, COMMENT_STATE, COMMENT_TEXT, COMPLETIONS, DUPLICATE_MAP, FACT_MARKS, LABEL_TYPES, LABELLED, METRICS, NONRESPONSE_DIM, QC, RELABELLED, REPORT,
    REPORT_OUT, SEGMENTS, SLICED_TEXT, VALIDATED_TYPES,
)
from earshot.session import configure, persist_bucketed, persist_table, scratch_tables
from earshot.sources.fact_files import FactFiles
from earshot.sources.retention import drop_expired, drop_old_days, expired_tables
from earshot.sources.tables import TableStore

# Answers prompts: (rows with PromptId and Message, stage, label type, round) -> completions.
Answer = Callable[[DataFrame, str, str, int], DataFrame]


class BalanceError(RuntimeError):
    """Rows were lost or doubled in a stage."""


@dataclass(frozen=True)
class Run:
    """Arguments of one day's run."""

    survey_type: str
    run_date: int
    cutoff: int
    answer: Answer
    products: Sequence[int] = field(default_factory=config.product_ids)
    batch_size: int | None = None
    retention_days: int = 3
    log_days: int = 90
    # Raw labels less like any entry of their list than this go to a table of rejects and become null.
    label_floor: float = 0.0
    use_cache: bool = True

    def buffer(self, stage: str) -> str:
        return f"{stage}_buffer_{self.run_date}_{self.survey_type}"

    def table(self, name: str) -> str:
        return f"{name}_{self.survey_type}"


def _keep(
    store: TableStore,
    run: Run,
    stage: str,
    started: float,
    checks: list[DataFrame],
    metrics: list[DataFrame],
) -> None:
    """Store a stage's balances, metrics and run time under its day; stop the run if a balance fails."""
    failed = []
    if checks:
        rows = reduce(DataFrame.unionByName, checks)
        kept = store.overwrite(f"checks/{run.run_date}/{run.table(stage)}", rows)
        failed = kept.filter(~F.col("Ok")).collect()
    seconds = (stage, "seconds", time.time() - started, run.run_date)
    rows = [store.spark.createDataFrame([seconds], METRICS), *metrics]
    store.overwrite(
        f"metrics/{run.run_date}/{run.table(stage)}", reduce(DataFrame.unionByName, rows)
    )
    if failed:
        told = "; ".join(f"{r['Check']}: {r['Expected']} and {r['Actual']}" for r in failed)
        raise BalanceError(f"{stage}: {told}")


def _answer_metrics(triaged: DataFrame, stage: str, run: Run) -> DataFrame:
    status = lambda s: F.count_if(F.col("Status") == s)
    return quality.run_metrics(
        triaged,
        stage,
        {"rows": F.count(F.lit(1)), **{s: status(s) for s in ("ok", "error", "unfinished", "missing")}},
        run.run_date,
    )


# -- intake


def reportable(fact: DataFrame, run: Run) -> DataFrame:
    """Responses that take part in the report, by comment id and without their texts."""
    rows = shape.eligible_for_report(fact, run.survey_type, run.cutoff)
    rows = shape.with_comment_id(shape.product_allowlist(rows, run.products))
    return rows.select(*report.FACT_COLUMNS)


def intake(
    store: TableStore,
    fact: DataFrame | FactFiles,
    dictionary: DataFrame,
    run: Run,
    vectors: DataFrame | None = None,
) -> None:
    """Bring the comment dimension and the nonresponses up to the fact, looking only at partitions of it that changed.

    With ``vectors`` (CommentId, Vector) new comments that closely match a reported one are
    mapped to it and need no processing of their own. Marks are stored last, so a run that died is repeated as a whole; every
    step gives the same result again. What makes a comment a nonresponse is settled when it first appears.
    """
    started = time.time()
    frame = fact.frame() if isinstance(fact, FactFiles) else fact
    rows = shape.eligible_responses(frame, run.survey_type, run.cutoff)
    rows = shape.product_allowlist(rows, run.products)
    settings = f"{run.survey_type},{run.cutoff},{sorted(run.products)}"
    marks = fact.marks(settings) if isinstance(fact, FactFiles) else arrivals.partition_marks(rows, settings)
    marks = persist_table(marks, "fact-marks")
    before = store.read_or_empty(run.table("fact_marks"), FACT_MARKS)
    # One number per changed day comes back.
    days = sorted(r["Partition"] for r in arrivals.changed_partitions(marks, before).collect() if r["Partition"] is not None)
    inside = F.col(arrivals.PARTITION).isin(days)
    fresh = persist_table(arrivals.counts_by_partition(shape.with_comment_id(rows.filter(inside))), "fresh-counts")
    counts = store.read_or_empty(run.table("comment_counts"), COMMENT_COUNTS)
    touched = persist_table(arrivals.touched_comments(counts.filter(inside), fresh), "comments-touched")
    stats = persist_table(arrivals.touched_stats(counts.filter(~inside), fresh, touched), "comment-stats")

    known = store.read_or_empty(run.table("comment_state"), COMMENT_STATE)
    texts = store.read_or_empty(run.table("comment_text"), SLICED_TEXT).select(*COMMENT_TEXT.names)
    silent = store.read_or_empty(run.table("nonresponse_dim"), NONRESPONSE_DIM)
    seen = known.select("CommentId").unionByName(silent.select("CommentId"))
    arrived = fresh.dropDuplicates(["CommentId"]).join(seen, "CommentId", "left_anti").select(*COMMENT_TEXT.names)
    flagged = persist_table(comments.nonresponse_split(arrived, dictionary), "comments-flagged")

    new_silent = flagged.filter("IsNonresponse").select(*COMMENT_TEXT.names)
    quiet = silent.select(*COMMENT_TEXT.names).unionByName(new_silent)
    quiet_stats = stats.join(quiet, "CommentId")
    kept_silent = silent.join(touched, "CommentId", "left_anti")
    responses = stats.join(quiet.select("CommentId"), "CommentId", "left_anti")
    sizes = comments.with_character_count(flagged)
    state = arrivals.refreshed_state(known, responses, touched, sizes)

    told = flagged.filter(~F.col("IsNonresponse")).select(*COMMENT_TEXT.names)
    _add_texts(store, run, told)
    if vectors is not None:
        old = store.read_or_empty(run.table("duplicate_map"), DUPLICATE_MAP)
        new = told.join(old.select("CommentId"), "CommentId", "left_anti")
        done = known.filter(F.col("ReportingDate").isNotNull()).join(state.select("CommentId"), "CommentId", "left_semi")
        reported = texts.join(done.select("CommentId"), "CommentId", "left_semi")
        with_vector = lambda df: df.join(vectors, "CommentId")
        candidates = persist_table(with_vector(new), "fuzzy-candidates")
        known_texts = persist_table(with_vector(reported), "fuzzy-reported")
        found = persist_table(fuzzy.fuzzy_duplicate_map(candidates, known_texts), "fuzzy-pairs")
        # All mapped comments, so that a run that died after writing the map is made good.
        grown = store.overwrite(run.table("duplicate_map"), fuzzy.maintain_duplicate_map(old, found))
        state = comments.mark_processed(state, grown, run.run_date)
    gone = persist_table(touched.join(stats.select("CommentId"), "CommentId", "left_anti"), "comments-gone")
    state = store.overwrite(run.table("comment_state"), state)
    silent = store.overwrite(run.table("nonresponse_dim"), shape.conform(kept_silent.unionByName(shape.conform(quiet_stats, NONRESPONSE_DIM)), NONRESPONSE_DIM))
    _remove_texts(store, run, gone)
    _replace_counts(store, run, fresh, days)
    store.overwrite(run.table("fact_marks"), marks)
    whole = store.read_or_empty(run.table("comment_counts"), COMMENT_COUNTS).groupBy("CommentId").agg(F.sum("ResponseCount").alias("ResponseCount"))
    _keep(
        store, run, "intake", started,
        [quality.conservation_check("intake", "comments = responses + nonresponses", [whole], [state, silent])],
        [
            quality.run_metrics(
                whole.join(silent.select("CommentId", F.lit(True).alias("IsNonresponse")), "CommentId", "left"), "intake",
                {
                    "responses": F.sum("ResponseCount"),
                    "distinct comments": F.count(F.lit(1)),
                    "distinct nonresponses": F.count_if("IsNonresponse"),
                    "changed partitions": F.lit(len(days)),
                },
                run.run_date,
            )
        ],
    )


def _add_texts(store: TableStore, run: Run, texts: DataFrame) -> None:
    """Add texts that are not there yet; no file that is there is touched."""
    there = store.read_or_empty(run.table("comment_text"), SLICED_TEXT).select("CommentId")
    new = texts.join(there, "CommentId", "left_anti").withColumn("Slice", _slice())
    new = persist_table(new, "texts-new")
    if not new.isEmpty():
        # Rows of a slice come together, in as many tasks as they need.
        store.append_partitions(run.table("comment_text"), new.hint("rebalance", F.col("Slice")), ["Slice"])


def _remove_texts(store: TableStore, run: Run, gone: DataFrame) -> None:
    """Delete the texts of comments that left the fact, by rewriting the slices they are in."""
    texts = store.read_or_empty(run.table("comment_text"), SLICED_TEXT)
    held = texts.select("CommentId", "Slice").join(gone, "CommentId", "left_semi")
    slices = [r["Slice"] for r in held.select("Slice").distinct().collect()]
    if not slices:
        return
    left = persist_table(texts.filter(F.col("Slice").isin(slices)).join(gone, "CommentId", "left_anti"), "texts-left")
    store.overwrite_partitions(run.table("comment_text"), left.hint("rebalance", F.col("Slice")), ["Slice"])
    present = {r["Slice"] for r in left.select("Slice").distinct().collect()}
    for name in set(slices) - present:
        store.drop_partition(run.table("comment_text"), {"Slice": name})


def _slice() -> Column:
    return F.concat(F.lit("s"), F.substring("CommentId", 1, 1))


def _replace_counts(store: TableStore, run: Run, fresh: DataFrame, days: list[int]) -> None:
    """Put the changed partitions' new counts in the place of their old ones."""
    name = run.table("comment_counts")
    rows = fresh.select(*COMMENT_COUNTS.names)
    present = {r[0] for r in rows.select(arrivals.PARTITION).distinct().collect()}
    if present:
        store.overwrite_partitions(name, rows.hint("rebalance", F.col(arrivals.PARTITION)), [arrivals.PARTITION])
    for day in set(days) - present:
        store.drop_partition(name, {arrivals.PARTITION: day})


def comment_dim(store: TableStore, run: Run) -> DataFrame:
    """The dimension of distinct comments with texts and work state."""
    return shape.conform(_with_text(store, run)(_state(store, run)), COMMENT_DIM)


def _state(store: TableStore, run: Run) -> DataFrame:
    return store.read(run.table("comment_state"), COMMENT_STATE)


def _with_text(store: TableStore, run: Run) -> Callable[[DataFrame], DataFrame]:
    texts = _texts(store, run)
    return lambda rows: rows.join(texts, "CommentId")


def _texts(store: TableStore, run: Run) -> DataFrame:
    return store.read_or_empty(run.table("comment_text"), SLICED_TEXT).select(*COMMENT_TEXT.names)


# -- completions


def _complete(
    store: TableStore, run: Run, keyed: DataFrame, stage: str, label_type: str,
    iteration: int, ask: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Ask for what has no usable answer yet, keep the answers, and triage all rows.

    Answers are kept by prompt for good, over days and survey types: an equal prompt is never paid for
    twice, and one that failed is asked again by the next run.
    """
    name = f"completions/{stage}_{label_type}_{iteration}"
    waiting = persist_table(completions.pending_prompts(keyed, store.parts(name, ANSWERS)), "prompts-waiting")
    if not waiting.isEmpty():
        answers = shape.conform(run.answer(ask(waiting), stage, label_type, iteration), COMPLETIONS)
        store.add(name, answers.withColumn("AskedOn", F.lit(run.run_date)))
    answered = completions.best_answers(store.parts(name, ANSWERS), F.col("AskedOn"))
    hot = hot_keys(keyed, ["PromptId"])
    return completions.triage(completions.complete_messages(keyed, answered, hot))


def _complete_types(
    store: TableStore, run: Run, keyed: DataFrame, stage: str, kinds: Sequence[str], iteration: int
) -> DataFrame:
    """The same for rows of several label types (``LabelType``) in one pass: one look for answers, one join of texts, one triage.

    Answers are still asked for and kept by type.
    """
    names = {kind: f"completions/{stage}_{kind}_{iteration}" for kind in kinds}
    kept = lambda: reduce(DataFrame.unionByName, [store.parts(n, ANSWERS) for n in names.values()])
    waiting = persist_table(completions.pending_prompts(keyed, kept()), "prompts-waiting")
    asked = completions.messages_by_type(_with_text(store, run)(waiting), stage, kinds, iteration)
    asked = persist_table(asked.drop("SurveyComment"), "prompts-asked")
    open_types = {r[0] for r in waiting.select("LabelType").distinct().collect()}
    for kind in kinds:
        if kind in open_types:
            part = asked.filter(F.col("LabelType") == kind).drop("LabelType")
            answers = shape.conform(run.answer(part, stage, kind, iteration), COMPLETIONS)
            store.add(names[kind], answers.withColumn("AskedOn", F.lit(run.run_date)))
    answered = completions.best_answers(kept(), F.col("AskedOn"))
    hot = hot_keys(keyed, ["PromptId"])
    return persist_table(completions.triage(completions.complete_messages(keyed, answered, hot)), f"{stage}-triaged")


def _set_aside(rows: DataFrame, triaged: list[DataFrame]) -> DataFrame:
    """Rows of comments with a bad answer in any of the triaged frames."""
    bad = reduce(DataFrame.unionByName, [t.filter("Status <> 'ok'").select("CommentId") for t in triaged])
    return rows.join(bad.distinct(), "CommentId", "left_semi")


def _one_per_segment(stage: str, rows: DataFrame) -> DataFrame:
    return quality.conservation_check(stage, "one row per segment", [rows], [rows.select(*labels.SEGMENT_KEY).distinct()])


def _quarantine(store: TableStore, run: Run, triaged: DataFrame, name: str) -> None:
    bad = completions.quarantine_rows(triaged, run.run_date)
    store.overwrite(f"quarantine/{run.run_date}/{run.table(name)}", bad)


# -- segmentation


def segmentation(store: TableStore, run: Run) -> bool:
    """Segment the waiting comments; false when there is nothing to do."""
    started = time.time()
    queue = comments.work_queue(_state(store, run), run.batch_size)
    batch = persist_table(_with_text(store, run)(queue.select("CommentId")), "batch")
    if batch.isEmpty():
        return False
    cache = store.parts("segment_cache", SEGMENTS)
    todo = segments.segment_cache_misses(cache, batch) if run.use_cache else batch
    keyed = persist_table(completions.segment_keys(todo), "segment-work")
    triaged = persist_table(
        _complete(store, run, keyed, "segment", "All", 0, completions.segment_messages),
        "segments-triaged",
    )
    _quarantine(store, run, triaged, "segment")
    good = triaged.filter("Status = 'ok'")
    fresh = persist_table(segments.segment_comments(good, run.run_date), "segments-fresh")
    rows = fresh
    if run.use_cache:
        hits = segments.segment_cache_hits(cache, batch).withColumn("RunDateId", F.lit(run.run_date))
        rows = fresh.unionByName(hits)
        store.add("segment_cache", segments.segment_cache_news(cache, fresh))
    rows = store.overwrite(run.buffer("segments"), rows)
    _keep(
        store, run, "segmentation", started,
        [
            quality.conservation_check(
                "segmentation", "work = good + quarantined", [keyed],
                [good, triaged.filter("Status <> 'ok'")],
            ),
            # Comments whose answer held no segment show up here as the difference.
            quality.conservation_check(
                "segmentation", "good comments = segmented comments", [good],
                [fresh.select("CommentId").distinct()],
            ),
            quality.conservation_check(
                "segmentation", "no repeated segment", [rows], [rows.distinct()]
            ),
        ],
        [_answer_metrics(triaged, "segmentation", run)],
    )
    return True


# -- labels


def labelling(store: TableStore, run: Run) -> None:
    """First round: four labels per segment, snapped to the closed lists, one row per segment."""
    started = time.time()
    work = store.read(run.buffer("segments"), SEGMENTS)
    work = comments.unprocessed_work(work, _state(store, run))
    work = persist_table(work, "label-work")
    keyed = completions.keys_by_type(completions.per_label_type(work, LABEL_TYPES), "assign", LABEL_TYPES)
    triaged = _complete_types(store, run, persist_table(keyed, "label-keys"), "assign", LABEL_TYPES, 0)
    good = persist_table(completions.good_rows(triaged, ["CommentId", "LabelType"]), "labels-good")
    checks, metrics = [], []
    for kind in LABEL_TYPES:
        of_kind = lambda df, kind=kind: df.filter(F.col("LabelType") == kind)
        _quarantine(store, run, of_kind(triaged).drop("LabelType"), f"assign_{kind}_0")
        metrics.append(_answer_metrics(of_kind(triaged), f"labelling {kind}", run))
        checks.append(
            quality.conservation_check(
                "labelling", f"{kind}: segments = labelled + dropped", [work],
                [of_kind(good), of_kind(triaged).join(of_kind(good).select("CommentId").distinct(), "CommentId", "left_anti")],
            )
        )
    first_answer = F.get("content", F.lit(0)).alias("Label")
    long = store.overwrite(run.buffer("labels"), good.select(*labels.SEGMENT_KEY, *labels.SEGMENT_BODY, first_answer, "LabelType"))
    wide = labels.labels_wide(long, LABEL_TYPES)
    if run.label_floor > 0:
        wide = persist_table(wide, "labels-wide")
        store.overwrite(f"rejects/{run.run_date}/{run.table('labels')}", labels.rejected_labels(wide, run.label_floor))
    wide = labels.snap_to_vocabulary(wide, floor=run.label_floor)
    first = shape.conform(labels.rename_workloads(wide), LABELLED)
    first = store.overwrite(run.buffer("labelled_first"), first.sortWithinPartitions(*labels.SEGMENT_KEY))
    checks.append(_one_per_segment("labelling", first))
    _keep(store, run, "labelling", started, checks, metrics)


def validation(store: TableStore, run: Run) -> None:
    """Have three of the labels checked; rows that fail in any check drop out with their comment."""
    started = time.time()
    rows = store.read(run.buffer("labelled_first"), LABELLED)
    metrics, asked = [], []
    keyed = completions.keys_by_type(completions.per_label_type(rows, VALIDATED_TYPES), "validate", VALIDATED_TYPES)
    triaged = _complete_types(store, run, persist_table(keyed, "validation-keys"), "validate", VALIDATED_TYPES, 0)
    good = persist_table(completions.good_rows(triaged, ["CommentId", "LabelType"]), "validations-good")
    parts = []
    for kind in VALIDATED_TYPES:
        of_kind = triaged.filter(F.col("LabelType") == kind)
        asked.append(of_kind)
        _quarantine(store, run, of_kind.drop("LabelType"), f"validate_{kind}")
        metrics.append(_answer_metrics(of_kind, f"validation {kind}", run))
        checked = labels.validated(good.filter(F.col("LabelType") == kind), kind)
        parts.append(
            checked.select(
                *labels.SEGMENT_KEY, F.lit(kind).alias("LabelType"),
                F.col(f"{kind}Label_validation").alias("Label_validation"),
            )
        )
    long = reduce(DataFrame.unionByName, parts)
    wide = labels.labels_wide(long, VALIDATED_TYPES, values=("Label_validation",))
    checked = store.overwrite(run.buffer("validated"), labels.join_on(rows, wide, labels.SEGMENT_KEY))
    _keep(
        store, run, "validation", started,
        [
            quality.conservation_check("validation", "labelled = validated + set aside", [rows], [checked, _set_aside(rows, asked)]),
            _one_per_segment("validation", checked),
        ],
        metrics,
    )


def relabelling(store: TableStore, run: Run) -> None:
    """Second round for labels that were not agreed to; then the comments count as processed."""
    started = time.time()
    checked = store.read(run.buffer("validated"))
    rows, metrics, asked = checked, [], []
    open_rows = reduce(
        DataFrame.unionByName,
        [
            checked.filter(~labels.agreed(kind)).select(
                *labels.SEGMENT_KEY, "Segment", F.lit(kind).alias("LabelType"),
                F.col(f"{kind}Label_validation")["Justification"].alias("Justification"),
            )
            for kind in VALIDATED_TYPES
        ],
    )
    keyed = persist_table(completions.keys_by_type(open_rows, "assign", VALIDATED_TYPES, 1), "relabel-keys")
    triaged = _complete_types(store, run, keyed, "assign", VALIDATED_TYPES, 1)
    good = persist_table(completions.good_rows(triaged, ["CommentId", "LabelType"]), "relabels-good")
    for kind in VALIDATED_TYPES:
        of_kind = triaged.filter(F.col("LabelType") == kind)
        asked.append(of_kind)
        _quarantine(store, run, of_kind.drop("LabelType"), f"assign_{kind}_1")
        metrics.append(_answer_metrics(of_kind, f"relabelling {kind}", run))
        second = completions.single_label(good.filter(F.col("LabelType") == kind).drop("LabelType"), kind)
        rows = labels.relabel_round(rows, second, kind)
    if run.label_floor > 0:
        rows = persist_table(rows, "labels-second")
        rejected = labels.rejected_labels(rows, run.label_floor, extra_workloads=(config.GENERIC_WORKLOAD,))
        store.overwrite(f"rejects/{run.run_date}/{run.table('relabels')}", rejected)
    snapped = labels.snap_to_vocabulary(rows, floor=run.label_floor, extra_workloads=(config.GENERIC_WORKLOAD,))
    final = labels.rename_workloads(snapped, second_round=True)
    final = shape.conform(final, RELABELLED).sortWithinPartitions(*labels.SEGMENT_KEY)
    done = store.overwrite(run.buffer("labelled"), final)
    _keep(
        store, run, "relabelling", started,
        [
            quality.conservation_check("relabelling", "validated = final + set aside", [checked], [done, _set_aside(checked, asked)]),
            _one_per_segment("relabelling", done),
        ],
        metrics,
    )
    # Labels wait in one table until a report shows them, whichever day that is; only then do comments count as processed.
    waiting = store.read_or_empty(run.table("labelled"), RELABELLED)
    store.overwrite(run.table("labelled"), done.unionByName(waiting.join(done.select("CommentId").distinct(), "CommentId", "left_anti").select(*done.columns)))
    state = comments.mark_processed(_state(store, run), done, run.run_date)
    store.overwrite(run.table("comment_state"), state)


# -- report


def rebuild_report(store: TableStore, fact: DataFrame, context: DataFrame, run: Run) -> DataFrame:
    """Replace the report of this survey type."""
    started = time.time()
    rows = persist_table(reportable(fact, run), "fact-keyed")
    state = _state(store, run)
    silent = store.read(run.table("nonresponse_dim"), NONRESPONSE_DIM)
    hot = persist_table(comments.hot_comments(state, silent), "hot-comments")
    labelled = store.read_or_empty(run.table("labelled"), RELABELLED).select(*LABELLED.names)
    processed = persist_table(report.processed_fact(rows, state, hot), "fact-processed")
    texts = _texts(store, run).unionByName(silent.select(*COMMENT_TEXT.names))
    buckets = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: report.attach_text(df, texts, hot).repartition(buckets, "FeedbackId")
    current = persist_table(dealt(report.current_report(processed, labelled, hot)), "report-current")
    # The earlier report is kept in buckets of the response and with its texts: it is not exchanged below.
    prior = store.read_bucketed(run.table("report"), REPORT_OUT).select(*REPORT.names, "SurveyComment")
    total = report.supersede_prior(
        current, report.restate_prior_report(rows, prior), dedupe=False
    )
    total = persist_bucketed(total, "report-total", "FeedbackId", buckets)
    if store.exists(run.table("duplicate_map")):
        pairs = store.read(run.table("duplicate_map"), DUPLICATE_MAP)
        added = persist_table(report.fan_out_duplicates(pairs, total, rows, hot), "report-fanned")
        store.overwrite(
            run.table("duplicate_map"), fuzzy.stamp_reported_pairs(pairs, added, run.run_date)
        )
        total = persist_bucketed(total.unionByName(dealt(added)), "report-with-fanned", "FeedbackId", buckets) if not added.isEmpty() else total
    repeats = report.unreported_repeats(processed, total)
    finished = report.assemble_report(
        total,
        report.inherit_labels(repeats, total, hot=hot),
        report.nonresponse_fact(rows, silent, hot),
        shape.empty_responses(rows),
        rows,
        shape.context_normalise(context),
        texts,
        run.survey_type,
        hot,
        buckets,
    )
    finished = store.overwrite_bucketed(run.table("report"), finished, "FeedbackId", buckets)
    reported = finished.select("FeedbackId").distinct()
    # Mapped comments are reported with the one they resemble, and stamped in the map.
    mapped = store.read_or_empty(run.table("duplicate_map"), DUPLICATE_MAP).select("CommentId")
    due = processed.join(mapped, "CommentId", "left_anti").select("FeedbackId").distinct()
    _keep(
        store, run, "report", started,
        [
            quality.conservation_check(
                "report", "no response outside the fact", [reported],
                [reported.join(rows.select("FeedbackId"), "FeedbackId", "left_semi")],
            ),
            quality.conservation_check(
                "report", "processed = reported", [due], [due.join(reported, "FeedbackId", "left_semi")]
            ),
        ],
        [
            quality.run_metrics(
                finished, "report",
                {"rows": F.count(F.lit(1)), "responses": F.count_distinct("FeedbackId")},
                run.run_date,
            )
        ],
    )
    state = store.overwrite(run.table("comment_state"), comments.mark_reported(state, finished, run.run_date))
    # Labels that no report shows yet stay.
    shown = state.filter(F.col("ReportingDate").isNotNull()).select("CommentId")
    waiting = store.read_or_empty(run.table("labelled"), RELABELLED)
    store.overwrite(run.table("labelled"), waiting.join(shown, "CommentId", "left_anti"))
    return finished


def quality_control(store: TableStore, run: Run) -> DataFrame:
    """Append today's label counts with their issue flags; stores and returns the alert rows."""
    state = _state(store, run)
    rows = store.read(run.table("report"), REPORT_OUT).filter(F.col("ReportingType") == "Report")
    current = quality.label_counts(rows, run.run_date)
    prior = store.read_or_empty(run.table("qc"), QC).filter(F.col("DIM_DateId") < run.run_date)
    if prior.isEmpty():
        flags = current.withColumn("IssueFlag", F.lit(False))
    else:
        drift = quality.label_drift(quality.latest_snapshot(prior), current, run.run_date)
        flags = quality.silence_backfill(drift, state, run.run_date)
    qc = shape.conform(quality.append_qc(prior, flags, run.survey_type), QC)
    alerts = quality.drift_alerts(store.overwrite(run.table("qc"), qc), run.run_date)
    return store.overwrite(f"alerts/{run.run_date}/{run.table('drift')}", alerts)


def cleanup(store: TableStore, run: Run) -> list[str]:
    """Delete buffer tables past their retention, and old days of balances, metrics, alerts and quarantine."""
    for log in ("checks", "metrics", "alerts", "quarantine", "rejects"):
        drop_old_days(store, log, run.run_date, run.log_days)
    return drop_expired(store, expired_tables(store.listing(), run.run_date, run.retention_days))


def run_day(
    store: TableStore,
    fact: DataFrame | FactFiles,
    dictionary: DataFrame,
    context: DataFrame,
    run: Run,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """All stages in order; labelling and validation are skipped when there is no new work."""
    configure(store.spark)
    with scratch_tables(store.spark):
        intake(store, fact, dictionary, run, vectors)
    with scratch_tables(store.spark):
        if segmentation(store, run):
            labelling(store, run)
            validation(store, run)
            relabelling(store, run)
    with scratch_tables(store.spark):
        rebuild_report(store, fact.frame() if isinstance(fact, FactFiles) else fact, context, run)
    alerts = quality_control(store, run)
    cleanup(store, run)
    return alerts
