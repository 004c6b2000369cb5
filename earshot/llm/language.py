"""Language identification by a byte convolutional network.

A text, A to Z in lower case, is cut into windows of ``WINDOW`` bytes, all of it, the last one filled up with zero bytes. Filters of several widths
slide over a window; each keeps its largest answer; a softmax layer turns these into language probabilities. The text's
probabilities are the mean over its windows, weighted by their bytes. The network is trained in numpy on the driver, on a sample
of about ``PER_LANGUAGE`` labelled documents a language and ``PER_DOCUMENT`` windows a document, the same on every run. All labels are learned;
with many of them a language's share of at most ``MOST_DOCUMENTS`` documents is smaller.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import LOWER, mapped, ranges, text_chunks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
PER_LANGUAGE = 500
PER_DOCUMENT = 6
MOST_DOCUMENTS = 128_000
LEAST_BYTES = 32
EPOCHS = 12
BATCH = 64
RATE = 0.02
SEED = 7
LEAST_SCORE = 0.4
UNKNOWN = "und"

PREDICTED = "doc_id long, lang_pred string, score double"


@dataclass
class Network:
    """taps: per width an array (width, 256, filters); bias per filter; the last layer's weights."""

    languages: list[str]
    taps: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        out, places = [], []
        for taps in self.taps:
            width = len(taps)
            n = windows.shape[1] - width + 1
            answer = taps[0].take(windows[:, :n], axis=0)
            for i in range(1, width):
                answer += taps[i].take(windows[:, i : i + n], axis=0)
            if where:
                places.append(answer.argmax(axis=1))
                out.append(np.take_along_axis(answer, places[-1][:, None, :], axis=1)[:, 0, :])
            else:
                out.append(answer.max(axis=1))
        return np.maximum(np.concatenate(out, axis=1) + self.bias, 0), places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return _softmax(self.pooled(windows)[0] @ self.weights + self.offset)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, their documents, their bytes) of all texts of a run."""
    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    doc = np.repeat(np.arange(len(lengths)), counts)
    start = offsets[:-1][doc] + ranges(np.zeros(len(counts), np.int64), counts) * size
    held = np.minimum(size, offsets[1:][doc] - start)
    padded = np.concatenate([LOWER[data], np.zeros(size, np.uint8)])
    at = start[:, None] + np.arange(size)
    out = padded[at]
    out[np.arange(size) >= held[:, None]] = 0
    return out, doc, held


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    rng = np.random.default_rng(SEED)
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, 0.3, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    for taps in net.taps:
        taps[:, 0, :] = 0  # the filler says nothing
    params = [*net.taps, net.bias, net.weights, net.offset]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    share = np.bincount(labels, minlength=len(languages)).astype(np.float64)
    importance = (len(labels) / (np.maximum(share, 1) * len(languages)))[labels].astype(np.float32)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = windows[rows], labels[rows]
            pooled, places = net.pooled(x, where=True)
            error = _softmax(pooled @ net.weights + net.offset)
            error[np.arange(len(rows)), y] -= 1
            error *= (importance[rows] / len(rows))[:, None]
            back = (error @ net.weights.T) * (pooled > 0)
            grads = []
            for k, taps in enumerate(net.taps):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                grad = np.zeros_like(taps)
                for i in range(len(taps)):
                    byte = np.take_along_axis(x, places[k] + i, axis=1)
                    np.add.at(grad[i], (byte, np.arange(FILTERS)[None, :]), own)
                grad[:, 0, :] = 0
                grads.append(grad)
            grads += [back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learnt from. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, per_document: int = PER_DOCUMENT) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Labelled windows for training: a share of each language's documents that a hash of the id picks.

    Windows of under ``LEAST_BYTES`` bytes train only where they are a document's only one. Columns besides doc_id, text and lang are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id")).alias("held_out"))
    usable = plain.where("lang IS NOT NULL AND text IS NOT NULL AND NOT held_out")
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    learned = counts.count()
    if not learned:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    per_language = min(per_language, max(1, MOST_DOCUMENTS // learned))
    share = counts.select("lang", (F.lit(float(per_language)) / F.col("n")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    small = F.broadcast(share) if learned <= MOST_DOCUMENTS else share
    picked = usable.join(small, "lang").where(draw < F.col("share")).select("doc_id", "text", "lang")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, data, offsets in text_chunks(batch.column(1)):
            cut, doc, held = windows_of(data, offsets)
            alone = np.bincount(doc, minlength=last - first)[doc] == 1
            keep = (held >= LEAST_BYTES) | alone
            cut, doc = cut[keep], doc[keep]
            if not len(doc):
                continue
            counts = np.bincount(doc, minlength=last - first)
            place = ranges(np.zeros(len(counts), np.int64), counts)
            every = np.maximum(1, counts[doc] // per_document)
            keep = (place % every == 0) & (place // every < per_document)
            rows = doc[keep] + first
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(place[keep]), batch.column(2).take(pa.array(rows)), pa.array([w.tobytes() for w in cut[keep]], pa.binary())],
                names=["doc_id", "place", "lang", "bytes"],
            )

    rows = mapped(picked, run, "doc_id long, place long, lang string, bytes binary").limit(2 * per_language * per_document * learned).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["place"], r["lang"], bytes(r["bytes"])))
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    number = {lang: i for i, lang in enumerate(languages)}
    return np.frombuffer(b"".join(bytes(r["bytes"]) for r in rows), np.uint8).reshape(-1, WINDOW), np.array([number[r["lang"]] for r in rows]), languages


def fit(docs: DataFrame) -> Network | None:
    windows, labels, languages = sample(docs)
    return train(windows, labels, languages) if languages else None


_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _with_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return out


def _scored(net: Network | None, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, whether there is something to tell, best language, its probability) of runs of texts."""
    for first, last, data, offsets in text_chunks(texts):
        n = last - first
        if net is None or not len(data):
            yield first, last, np.zeros(n, bool), np.zeros(n, np.int64), np.zeros(n)
            continue
        cut, doc, held = windows_of(data, offsets)
        sums = np.zeros((n, len(net.languages)))
        for at in range(0, len(cut), 64):  # arrays that fit a core's cache
            part = slice(at, at + 64)
            np.add.at(sums, doc[part], net.probabilities(cut[part]) * held[part, None])
        best = sums.argmax(axis=1)
        score = np.clip(sums[np.arange(n), best] / np.maximum(np.diff(offsets), 1), 0, 1)
        yield first, last, _with_letter(data, offsets), best, score


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row; repeated rows are predicted each.

    ``und`` with score 0 if the text is null, empty or without a letter, or if there was nothing to learn from. Columns other
    than doc_id and text are not read. Equal probabilities go to the language that sorts first.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for first, last, known, best, score in _scored(net, batch.column(1)):
            names = [net.languages[k] if there else UNKNOWN for k, there in zip(best.tolist(), known.tolist(), strict=True)]
            ids = batch.column(0).slice(first, last - first)
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PREDICTED)


def identify(docs: DataFrame) -> DataFrame:
    """Predictions of a network fitted on the documents' own labels, held-out ones excluded."""
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is one of the learned ones with a score of at least ``least``; all columns stay.

    Each row is judged by its own text, so repeated rows and null ids are kept or dropped like any other, and no join is needed.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    text = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(batch.num_rows, bool)
        for first, last, known, _, score in _scored(sent.value, batch.column(text)):
            keep[first:last] = known & (score >= least)
        yield batch.filter(pa.array(keep))

    return mapped(docs, run, docs.schema)
