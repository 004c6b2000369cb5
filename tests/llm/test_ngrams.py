"""The similarity join against brute force, and components."""

import random
import re

import numpy as np

from earshot.llm import ngram_join
from earshot.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def sets_plain(text):
    words = WORD.findall((text or "").encode().translate(LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def plain(rows):
    """(order, size, component) of all rows, a null id as -1."""
    sets = [sets_plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((-1 if i is None else i, len(sets[k]), least.get(find(k), -1)) for k, (i, _) in enumerate(rows))


def joined(frame):
    out = ngram_join.join(frame).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out)


def test_join(docs, corpus):
    assert joined(docs) == plain(corpus)


def test_join_of_many_sizes(spark):
    """Sets of all sizes, at and around the limit, and a chain of near copies in one large group."""
    rng = random.Random(9)
    rows = []
    for n in (4, 5, 6, 9, 24, 60, 68, 70, 90, 130, 200, 260, 500):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for share in (0, 1, n // 60, n // 45, n // 40, n // 20):
            other = list(words)
            for k in rng.sample(range(n), min(n, share)):
                other[k] = f"y{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(other)))
        rows.append((len(rows), " ".join(words[: max(1, n * 4 // 5)])))
        rows.append((len(rows), " ".join(words[: max(1, n * 5 // 6)]).upper()))
    base = [f"c{k}" for k in range(150)]
    for k in range(60):
        base[k * 2] = f"d{k}"
        rows.append((len(rows), " ".join(base)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert joined(frame) == plain(rows)


def test_blocks_and_leftover_pairs(spark, monkeypatch):
    """Pairs that do not go through a group's smallest node are found too, whatever the block size."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for g in range(8):
        own = [f"g{g}v{rng.randrange(10**6)}" for _ in range(30)]
        for c in range(3):
            rows.append((len(rows), " ".join(passage + own + [f"t{c}"])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert joined(frame) == plain(rows)


def in_chunk(texts):
    raw = [t.encode() for t in texts]
    sets = ngram_join.Sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]))
    full = np.flatnonzero(np.diff(sets.bounds))
    return sets, full, ngram_join._bands(np.diff(sets.bounds)[full])


def test_sketch_distance_never_exceeds_the_difference():
    rng = random.Random(0)
    for n in (70, 300, 1500):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        sets, full, bands = in_chunk([" ".join(words), " ".join(words[n // 9 :] + [f"x{k}" for k in range(n // 7)])])
        data, edges = ngram_join._sketches(sets, full, bands)
        x, y = (data[edges[i] : edges[i + 1]] for i in (0, 1))
        size = min(len(x), len(y))
        distance = np.bitwise_count(ngram_join._folded(x[None], size) ^ ngram_join._folded(y[None], size)).sum()
        assert distance <= len(np.setxor1d(sets[0], sets[1]))


def test_a_set_has_the_same_node_sketch_and_buckets_in_any_chunk():
    rng = random.Random(5)
    texts = ["", " ", "one", "a b c d"] + [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (5, 9, 10, 35, 67, 68, 69, 90, 131, 400, 3000)]
    rng.shuffle(texts)
    sets, full, bands = in_chunk(texts)
    node, (sketch, edges), (keys, ends) = ngram_join._node_hashes(sets, full), ngram_join._sketches(sets, full, bands), ngram_join._bucket_lists(sets, full, bands)
    assert len(full) == len(texts) - 2
    for k, i in enumerate(full):
        one, own, band = in_chunk([texts[i]])
        assert ngram_join._node_hashes(one, own)[0] == node[k]
        assert (ngram_join._sketches(one, own, band)[0] == sketch[edges[k] : edges[k + 1]]).all()
        assert (ngram_join._bucket_lists(one, own, band)[0] == keys[ends[k] : ends[k + 1]]).all()
        n = len(sets[i])
        least = int(ngram_join.most_difference(np.int64(n), np.int64(n * 100 // 80))) + 1
        assert len(set(keys[ends[k] : ends[k + 1]].tolist())) >= min(n, least)


def test_keep_one(docs, corpus, empty):
    out = ngram_join.keep_one(docs)
    assert out.schema == docs.schema
    order = lambda i: -(1 << 63) if i is None else i
    kept = sorted((order(r.doc_id), r.text or "") for r in out.collect())
    sets = [(order(i), t or "", sets_plain(t)) for i, t in corpus]
    want = []
    root = {}
    ids = sorted({(i, t) for i, t, s in sets if s})
    for p in ids:
        root[p] = p

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    by = {(i, t): s for i, t, s in sets}
    for a in ids:
        for b in ids:
            if b < a and 100 * len(by[a] & by[b]) >= 80 * len(by[a] | by[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = [p for p in ids if find(p) == p] + [(i, t) for i, t, s in sets if not s]
    assert kept == sorted(want)
    assert ngram_join.keep_one(empty).count() == ngram_join.join(empty).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + k, 301 + k) for k in range(50)] + [(5, 5), (7, 7)]
    root = list(range(400))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x for a, b in links for x in (a, b) if a != b}
    assert set(got) == want and all(got[x] == find(x) for x in want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
