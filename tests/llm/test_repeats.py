"""Line, byte-string and word-sequence removal against plain definitions."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from earshot.llm import line_dedup, substring_dedup, suffix_dedup
from earshot.llm.common import ranges, window_minima
from earshot.llm.paths import smallest_places

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def order(i):
    return -(1 << 63) if i is None else i


def test_ranges_and_minima():
    assert ranges(np.array([5, 9, 0]), np.array([2, 0, 3])).tolist() == [5, 6, 0, 1, 2]
    values = np.random.default_rng(0).integers(0, 1 << 62, 500).astype(np.uint64)
    for width in (1, 2, 3, 8, 13, 100, 500):
        want = [i + int(np.argmin(values[i : i + width])) for i in range(501 - width)]
        assert window_minima(values, width).tolist() == want == smallest_places(values, width).tolist()
    assert len(smallest_places(values[:3], 4)) == 0


def lines_plain(corpus, least):
    docs = sorted({(order(i), t or "") for i, t in corpus})
    seen, gone = {}, Counter()
    found = {}
    for at, (i, text) in enumerate(docs):
        lines = text.split("\n")
        solid = [(k, len(WORD.findall(x.encode()))) for k, x in enumerate(lines)]
        solid = [(k, n) for k, n in solid if n]
        for a in range(len(solid)):
            total, b = 0, a
            while b < len(solid) and total < least:
                total += solid[b][1]
                b += 1
            if total >= least:
                key = tuple(lines[k] for k, _ in solid[a:b])
                if key in seen:
                    found.setdefault(at, set()).update(k for k, _ in solid[a:b])
                else:
                    seen[key] = (at, a)
    return {(i, t): (len(t.split("\n")), len(found.get(at, ())), "\n".join(x for k, x in enumerate(t.split("\n")) if k not in found.get(at, ()))) for at, (i, t) in enumerate(docs)}


def test_lines(docs, corpus):
    want = lines_plain([r for r in corpus if r[1] is not None], line_dedup.MIN_WORDS)
    got = sorted((order(r.doc_id), r.text or "", r.n_lines, r.n_removed) for r in line_dedup.dedup(docs).collect())
    expected = []
    for i, t in corpus:
        if t is None:
            expected.append((order(i), "", 0, 0))
        else:
            n, removed, kept = want[(order(i), t)]
            expected.append((order(i), kept, n, removed))
    assert got == sorted(expected)
    assert sum(r[3] for r in got) > 20


def test_lines_split_each_text_once(spark):
    body = "\n".join(f"line {i}" for i in range(50))
    docs = spark.createDataFrame([(1, body, 0), (2, f"{body}\nown", 0), (3, body, 0), (4, None, 0)], "doc_id long, text string, n_chars long")
    for out, want in ((line_dedup.keep_first(docs), [(1, body), (2, "own"), (4, None)]), (line_dedup.dedup(docs), [(1, body), (2, "own"), (3, ""), (4, None)])):
        # A text split inside a lambda or a filter would be split again for each of its lines.
        assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
        assert sorted((r.doc_id, r.text) for r in out.collect()) == want


def test_short_lines_between_differing_neighbours(spark):
    """A repeated line goes however short it is, and whatever stands around it."""
    rows = [(k, f"opening number {k}\nAll rights reserved.\n\nclosing words of number {k} that differ from all others") for k in range(4)]
    rows += [(10, "All rights reserved."), (11, "Home\nhere\nHome"), (12, "home")]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[k] == (rows[k][1].replace("All rights reserved.\n", ""), 1) for k in range(1, 4))
    assert got[10] == ("", 1) and got[11] == ("Home\nhere", 1) and got[12] == ("home", 0)


def test_selected_places():
    """Windows select as a plain loop does, and every run of a window's length that two documents share has a common place."""
    rng = random.Random(8)
    shared = [f"shared {k}" for k in range(9)]
    texts = []
    for n in (0, 1, 2, 3, 4, 5, 20, 60):
        own = [f"own {rng.randrange(99)}" if rng.random() < 0.9 else " " for _ in range(n)]
        texts.append("\n".join(own[: n // 2] + shared[: 9 if n > 4 else 0] + own[n // 2 :]).encode())
    lines = line_dedup.Lines(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    chosen = set(lines.selected(4).tolist())
    want = set()
    for d in range(len(texts)):
        own = np.flatnonzero(lines.doc == d).tolist()
        for k in range(max(1, len(own) - 3) if own else 0):
            window = own[k : k + 4]
            want.add(max(window, key=lambda i: (-int(lines.hash[i]), i)))
    assert chosen == want
    runs = [{int(lines.hash[i]) for i in chosen if lines.doc[i] == d} for d in (5, 6, 7)]
    hashes = [[int(h) for h in lines.hash[lines.doc == d]] for d in (5, 6, 7)]
    common = [h for h in hashes[0] if h in hashes[1] and h in hashes[2]]
    assert len(common) >= 9 and set(common) & runs[0] & runs[1] & runs[2]


def test_runs_are_found_by_places_and_extension(spark):
    """Runs of a window's length or more are whole after extension; shorter ones are left to the second step."""
    from earshot.llm.common import Scratch

    run = [f"line {k} of the run" for k in range(15)]
    rows = [(1, "\n".join(["a", *run, "b"])), (2, "\n".join(["c", "d", *run[:7], " ", *run[7:], "e", "f", "g"])), (3, "\n".join(["h", *run[3:7], "i"])), (4, "\n".join(["j", "k", run[5], "l"]))]
    lines = line_dedup.line_hashes(spark.createDataFrame(rows, "doc_id long, text string"))
    covered = {}
    for r in line_dedup.later_runs(lines, Scratch(spark)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.low, r.high + 1))
    assert covered[2] == set(range(2, 17)) and covered[3] == {1, 2, 3, 4} and 1 not in covered
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 15, 3: 4, 4: 1}


@pytest.mark.parametrize("width", [1, 2, 6])
def test_lines_by_any_window(docs, width):
    assert sorted(map(str, line_dedup.dedup(docs, width).collect())) == sorted(map(str, line_dedup.dedup(docs).collect()))


def test_lines_keep_columns(docs, empty):
    out = line_dedup.keep_first(docs)
    assert out.schema == docs.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[71].n_chars == len(rows[71].text) and 80 not in rows and rows[90].text is None and rows[91].text == ""
    assert line_dedup.keep_first(empty).count() == line_dedup.dedup(empty).count() == 0


def bytes_plain(corpus, length):
    texts = [(t or "").encode() for _, t in corpus]
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(corpus, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = True
        gone = gone[: len(t)]
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
        out.append((order(i), len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out)


@pytest.mark.parametrize(("length", "anchor", "bucket"), [(200, 24, 4096), (40, 8, 4096), (40, 8, 2), (17, 5, 3)])
def test_bytes(docs, corpus, length, anchor, bucket):
    """Also with buckets so small that windows are counted instead."""
    got = sorted((order(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(docs, length, anchor, bucket).collect())
    assert got == bytes_plain(corpus, length)


def test_suffix_order_is_that_of_the_bytes():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start = np.sort(rng.integers(0, 380, 120))
    length = np.minimum(20, 400 - start)
    bucket = np.repeat(np.arange(8), 15)
    got = suffix_dedup.Suffixes(data, start, length, bucket)
    key = [(int(b), data[s : s + n].tobytes()) for b, s, n in zip(bucket, start, length, strict=True)]
    ordered = [key[k] for k in got.order]
    assert ordered == sorted(key)
    shared = [len(x) if (x := [p for p, q in zip(a[1], b[1], strict=False)]) and a[1][: len(x)] == b[1][: len(x)] else next((k for k, (p, q) in enumerate(zip(a[1], b[1], strict=False)) if p != q), 0) for a, b in zip(ordered, ordered[1:], strict=False)]
    assert got.shared[1:].tolist() == [s if a[0] == b[0] else -1 for s, a, b in zip(shared, ordered, ordered[1:], strict=False)]


def words_plain(corpus, window):
    docs = [(order(i), WORD.findall((t or "").encode())) for i, t in corpus]
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize(("window", "anchor"), [(13, 4), (4, 2)])
def test_word_sequences(docs, corpus, window, anchor):
    got = sorted((order(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.dedup(docs, window, anchor).collect())
    assert got == words_plain(corpus, window)


def test_empty_tables(empty):
    assert suffix_dedup.dedup(empty).count() == substring_dedup.dedup(empty).count() == 0
