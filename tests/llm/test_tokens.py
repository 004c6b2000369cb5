"""Encoding, packing and token files."""

import random
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from earshot.llm import packing, token_files
from earshot.llm.common import text_chunks
from earshot.llm.encoding import encoder, vocabulary_path


@pytest.fixture(scope="module")
def ids():
    tokenizer = encoder(vocabulary_path()).tokenizer
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(ids):
    rng = random.Random(2)
    odd = ["a", "Word", "é", ".", " ", " ", "\n", "\t", "\xa0", "1", "\x1c", "'s", "<|endoftext|>", "　", "ñ", "!", "́", "​", "α", "中", "-"]
    plain = ["a", "Word", "é", ".", " ", "\n", "'s", "1", "%", "ø"]
    texts = ["".join(rng.choice(odd if k % 2 else plain) for _ in range(rng.randint(0, 14))) for k in range(3000)] + [None, "", " ", "\n"]
    for first, last, data, offsets in text_chunks(pa.array(texts)):
        got, bounds = encoder(vocabulary_path()).chunk(data, offsets)
        for i in range(last - first):
            assert got[bounds[i] : bounds[i + 1]].tolist() == ids(texts[first + i]), repr(texts[first + i])


def test_partition_is_even_and_whole():
    rng = random.Random(1)
    for n in (1, 2, 7, 60, 300):
        sizes = [rng.randint(1, 512) for _ in range(n)]
        made = packing.partition(sizes, 2048)
        assert sorted(i for one in made for i in one) == list(range(n))
        sums = [sum(sizes[i] for i in one) for one in made]
        assert max(sums) <= 2048
        if n >= 60:
            assert max(sums) - min(sums) <= 100 and len(made) <= -(-sum(sizes) // 2048) + 2
    assert [len(x) for x in packing.partition([2048, 2048], 2048)] == [1, 1]


def test_pack(spark, docs, corpus, ids, empty):
    path = vocabulary_path()
    rows = packing.pack(docs, path).collect()
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append(r)
    for pieces in held.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    order = lambda i: -1 if i is None else i
    got = sorted((order(r.doc_id), r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for i, text in corpus:
        own = np.array([*ids(text), 1], "<u4")
        for a, n in packing.cut(len(own), 2048, packing.PIECE):
            want.append((order(i), len(own), a, n, zlib.crc32(own[a : a + n].tobytes())))
    assert got == sorted(want)
    total = sum(r.length for r in rows)
    assert len(held) * 2048 - total < 2048 + 0.1 * total
    assert packing.pack(empty, path).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(4)
    for n, kinds in ((0, 1), (1, 1), (5000, 3), (5000, 60), (40000, 2000), (3000, 1)):
        ids = rng.integers(10, 10 + kinds, n).astype(np.uint32)
        ids[rng.random(n) < 0.01] = 2
        rules, lengths, seq = token_files.compress(ids, 2)
        assert token_files.expand(seq, rules, lengths).tolist() == ids.tolist()
        assert token_files._spans(seq, lengths).sum() == n
        pairs = rules[rules < token_files.FIRST_NEW]
        assert not (pairs == 2).any()  # no rule crosses the end of a document
        if kinds == 3:
            assert len(seq) < n


def pairs_left(seq, barrier=2):
    """Pairs of neighbours by how often they occur; those that overlap in a run of one id count once."""
    runs = [(k, len(list(same))) for k, same in groupby(seq)]
    found = Counter(pair for pair in zip([k for k, _ in runs], [k for k, _ in runs[1:]]) if barrier not in pair)
    for k, n in runs:
        found[k, k] += n // 2 if k != barrier else 0
    return found


def test_every_pair_that_occurs_twice_is_replaced():
    rng = np.random.default_rng(11)
    # pairs that a sample of every eighth place would miss, more of them than one round or its slots take, and runs
    rare = np.concatenate([[k, k + 40_000, 5] for k in (*range(1000, 1300), *range(1000, 1300))])
    cases = [rare, np.full(999, 7), np.array([7, 7, 7, 8, 7, 7, 7, 9]), np.tile([0, 0, 5, 9, 0, 0], 3), rng.integers(10, 400, 30_000), np.tile(rng.permutation(60_000)[:20_000] + 10, 2)]
    for case in cases:
        ids = case.astype(np.uint32)
        ids[rng.random(len(ids)) < 0.002] = 2
        rules, lengths, seq = token_files.compress(ids, 2)
        assert token_files.expand(seq, rules, lengths).tolist() == ids.tolist()
        assert max(pairs_left(seq.tolist()).values(), default=0) < 2
    assert len(token_files.compress(cases[1].astype(np.uint32), 2)[2]) < 20
    # the most frequent pair goes first and has all of its places
    rules, _, _ = token_files.compress(np.array([4, 5, 6, 4, 5, 3, 5, 6, 4, 5, 9, 4, 5], np.uint32), 2)
    assert rules[0].tolist() == [4, 5]


def test_files_round_trip(spark, docs, corpus, ids, empty):
    path = vocabulary_path()
    got = [tuple(r) for r in token_files.round_trip(docs, path, shard_ids=700).collect()]
    order = lambda i: -(1 << 63) if i is None else i
    at, want = 0, []
    for i, text in sorted(corpus, key=lambda r: (order(r[0]), r[1] is not None, (r[1] or "").encode())):
        own = np.array([*ids(text), 2], "<u4")
        want.append((i, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_files.round_trip(empty, path).count() == 0


def test_random_access(ids):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    all_ids = [np.array([*ids(t), 2], np.uint32) for t in texts]
    rules, lengths, seq = token_files.compress(np.concatenate(all_ids), 2)
    shard = {"doc_sizes": np.array([len(x) for x in all_ids], "<i8").tobytes(), "rules": rules.tobytes(), "lengths": lengths.tobytes(), "symbols": seq.tobytes()}
    for k in (0, 1, 57, 199):
        assert token_files.read_document(shard, k).tolist() == all_ids[k].tolist()
