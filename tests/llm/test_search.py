"""Secrets, languages, neighbours, decontamination and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import decontaminate, language, neighbours, secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base_plain(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_fixed_patterns(spark, corpus):
    rng = random.Random(6)
    parts = ["password", "Api_Key", "apikey", "SECRET", "token", ":", "=", " = ", '"', "'", " ", "\n", "é", "中", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "deadbeefdeadbeef0", "abcdefghijkl", "x.y/z+w_1-2=", "ABCDEFGHIJ0123", "short"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(-1, None), (-2, "")] + [(10_000 + k, t) for k, (_, t) in enumerate(corpus)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        listed = base_plain(t or "")
        own = [s for s in got[i].spans.split(",") if s and not s.startswith("random")]
        assert ",".join(own) == listed, (i, t)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(listed.count(f"{k}:") for k in secrets.KINDS[:3])
    assert sum(got[i].n_assign for i in range(1500)) > 100


def battery_plain(body):
    """The p-value by the definitions, with exact normal tails."""
    from math import erfc, sqrt

    symbols = next(s for p, s in secrets.ALPHABETS if re.search(p, body))
    n, a = len(body), len(symbols)
    counts = np.array([body.count(c) for c in symbols])
    tail = lambda z: erfc(z / sqrt(2)) / 2
    chi = ((counts - n / a) ** 2 / (n / a)).sum()
    p1 = tail((chi - (a - 1)) / sqrt(2 * (a - 1) * (1 - 1 / n)))
    v = np.array([symbols.index(c) + 1 for c in body], float)
    high = v > a / 2
    ups = high.sum()
    expected = 2 * ups * (n - ups) / n
    runs = 1 + (high[1:] != high[:-1]).sum()
    p2 = 2 * tail(9.0 if expected <= 1 else abs(runs - 1 - expected) / sqrt(expected * (expected - 1) / (n - 1)))
    d = v - v.mean()
    p3 = 2 * tail(9.0 if (d * d).sum() <= 0 else abs((d[1:] * d[:-1]).sum() / (d * d).sum() * sqrt(n) + 1 / sqrt(n)))
    return min(1.0, max(1e-30, 3 * min(p1, p2, p3)))


def test_battery(spark):
    rng = random.Random(8)
    bodies = ["".join(rng.choice(s) for _ in range(rng.choice([20, 24, 32, 40, 64]))) for _, s in secrets.ALPHABETS for _ in range(20)]
    bodies += ["thisisalongidentifier2", "aaaaaaaaaaaaaaaaaaaaaaaa1", "ababababababababababab12", "user-profile-settings-page-2"]
    got = {r.body: r.p for r in secrets.tested(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()}
    for b in bodies:
        want = battery_plain(b)
        assert abs(got[b] - want) < 3e-3 or abs(np.log10(got[b]) - np.log10(want)) < 0.3, (b, got[b], want)


def test_random_tokens_are_told_from_made_up_ones(spark):
    rng = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    drawn = ["".join(rng.choice(letters) for _ in range(40)) + "7a" for _ in range(60)]
    made = [f"{'-'.join(rng.choice(['user', 'profile', 'setting', 'static', 'images', 'header']) for _ in range(6))}-{k}" for k in range(60)]
    rows = [(k, f"see {t} now") for k, t in enumerate(drawn + made)]
    got = {r.doc_id: r.n_random for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[k] for k in range(60)) >= 54 and sum(got[k] for k in range(60, 120)) <= 3
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- languages


@pytest.fixture(scope="module")
def speech(spark):
    rng = random.Random(3)
    sounds = {"aa": ["ka", "ti", "mo", "ne"], "bb": ["sch", "ung", "er", "ß"], "cc": ["ño", "ll", "ar", "és"]}
    rows = []
    for k in range(900):
        lang = rng.choice(list(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 150)))
        rows.append((k, text, None if k % 50 == 0 else lang, "d"))
    rows += [(1000, None, "aa", "d"), (1001, "", "bb", "d"), (1002, "123 456 --", "cc", "d"), (1003, "中文", None, "d"), (None, "kati mone", "aa", "d"), (1004, "kati " * 60000, "aa", "d"), (1004, "kati " * 60000, "aa", "d")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(4)


def test_language_with_clashing_columns_and_short_texts(spark, speech, monkeypatch):
    """Helper columns' names may be taken; a language of short texts alone is learned; a bound on documents leaves no language out."""
    short = spark.createDataFrame([(5000 + k, "zuzuzu" + "zu" * (k % 5), "dd", "d") for k in range(240)], speech.schema)
    more = speech.unionByName(short)
    for name in ("share", "n", "held_out", "lang_pred"):
        more = more.withColumn(name, F.lit("x"))
    got = {r.doc_id: r for r in language.identify(more).collect()}
    assert all(got[5000 + k].lang_pred == "dd" for k in range(240))
    assert language.keep_known(more).columns == more.columns
    monkeypatch.setattr(language, "MOST_DOCUMENTS", 80)
    windows, labels, languages = language.sample(more)
    assert languages == ["aa", "bb", "cc", "dd"] and set(labels.tolist()) == {0, 1, 2, 3} and len(windows) < 80 * language.PER_DOCUMENT


def test_language(speech):
    rows = speech.collect()
    got = language.identify(speech).collect()
    assert len(got) == len(rows)
    label = {r.doc_id: r.lang for r in rows}
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in ("aa", "bb", "cc", "und")
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1000, 1001, 1002)) and by[1003].lang_pred != "und"
    tested = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900 and label[r.doc_id]]
    assert np.mean([r.lang_pred == label[r.doc_id] for r in tested]) > 0.95
    assert [r.lang_pred for r in got if r.doc_id == 1004] == ["aa", "aa"]


def test_language_of_held_out_rows_is_never_read(speech):
    """Labels of held-out rows change nothing."""
    other = speech.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    one = sorted(map(str, language.identify(speech).collect()))
    assert one == sorted(map(str, language.identify(other).collect()))


def test_language_filter_and_empty_tables(speech):
    kept = language.keep_known(speech)
    assert kept.schema == speech.schema
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert not {1000, 1001, 1002} & set(ids) and ids.count(1004) == 2 and len(ids) > 800
    assert language.identify(speech.limit(0)).count() == language.keep_known(speech.limit(0)).count() == 0
    unlabelled = language.identify(speech.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_windows_cover_whole_texts():
    data = np.frombuffer(b"abcdefgh" + b"xyz", np.uint8)
    cut, doc, held = language.windows_of(data, np.array([0, 8, 8, 11]), 3)
    assert [bytes(w[:h]) for w, h in zip(cut, held, strict=True)] == [b"abc", b"def", b"gh", b"xyz"] and doc.tolist() == [0, 0, 0, 2]


# -- neighbours


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16))
    x[300:420] = x[7]  # one very common vector
    x[430] = x[8] * 3
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15), (1200, [float("inf")] + [1.0] * 15), (1250, [1.0, 2.0]), (None, x[3].tolist()), (50, x[50].tolist())]
    table = spark.createDataFrame([(k, v, "e") for k, v in rows], "vec_id long, embedding array<double>, node string").repartition(4)
    got = {}
    for r in neighbours.nearest(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    queries = [k for k in range(700) if k % 50 == 0]
    assert sorted(got) == queries
    for q in queries:
        close = unit @ unit[q]
        close[q] = -9
        want = np.lexsort((np.arange(700), -np.round(close, 12)))[:5]
        rows = sorted(got[q])
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert all(abs(s - close[v]) < 1e-12 for _, v, s in rows)
        assert rows == [(k + 1, *r[1:]) for k, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[1])))]
        hits += len({r[1] for r in rows} & set(want.tolist()))
        total += 5
    assert hits >= 0.9 * total
    assert [r[1] for r in sorted(got[350])] == [7, 300, 301, 302, 303]  # ties go to the smaller ids


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0])], schema)).count() == 0
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]


def test_search_goes_on_until_all_is_open(spark):
    """A path of 9 nodes is walked to its end."""
    angle = np.arange(9) / 9
    points = neighbours.nodes(spark.createDataFrame([([float(np.cos(a)), float(np.sin(a))],) for a in angle], "vec array<double>")).collect()
    unit = {np.arctan2(*np.frombuffer(r.unit, np.float16).astype(float)[::-1]): r.node for r in points}
    path = [unit[a] for a in sorted(unit)]
    graph = spark.createDataFrame([(a, b, 0.9) for a, b in zip(path, path[1:], strict=False)], neighbours.EDGES)
    found = neighbours.search(spark.createDataFrame([(path[0],)], "q long"), spark.createDataFrame(points), graph).collect()
    assert {r.w for r in found} == set(path)


def test_graph_settles(spark):
    """Vectors without clusters need more than a few rounds."""
    x = np.random.default_rng(4).normal(size=(5000, 48))
    points = neighbours.nodes(spark.createDataFrame([(v.tolist(),) for v in x], "vec array<double>")).localCheckpoint()
    graph = {}
    for r in neighbours.build(points).collect():
        graph.setdefault(r.u, set()).add(r.v)
    rows = points.collect()
    node = np.array([r.node for r in rows])
    unit = np.stack([np.frombuffer(r.unit, np.float16).astype(np.float32) for r in rows])
    close = unit @ unit.T
    np.fill_diagonal(close, -9)
    best = np.argsort(-close, axis=1)[:, : neighbours.DEGREE]
    assert np.mean([v in graph[u] for u, row in zip(node.tolist(), node[best].tolist(), strict=True) for v in row]) > 0.97


# -- decontamination


@pytest.fixture(scope="module")
def exam(spark):
    rng = random.Random(12)
    vocab = [f"{a}{b}" for a in ("qua", "ste", "plo", "mri", "vex", "dun", "hap", "zor") for b in ("ma", "lin", "tor", "ka", "ves", "nd", "ique", "ol")]
    common = ["the", "of", "and", "in", "to", "is"]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n))
    items = [(k, f"{text(rng.randint(12, 40)).capitalize()}? {text(6).capitalize()}.") for k in range(30)]
    items += [(30, text(150) + "."), (31, "too short"), (34, "Zor vesma, quaol?"), (35, "Unseen"), (32, None), (33, ""), (0, items[0][1]), (None, text(25))]
    docs = [(k, text(rng.randint(0, 400)), "s") for k in range(120)]
    planted = []
    for k in range(0, 40):
        item, body = items[k % 31]
        words = text(300).split(" ")
        at = rng.randrange(len(words))
        form = body if k % 3 else body.upper().replace("?", " !")
        docs.append((200 + k, " ".join([*words[:at], form, *words[at:]]), "s"))
        planted.append((200 + k, item))
    docs += [(400, None, "s"), (401, "", "s"), (402, " ".join([items[4][1]] * 50), "s"), (402, items[5][1], "s"), (None, items[6][1], "s"), (403, text(20000), "s")]
    planted += [(402, 4), (402, 5), (None, 6)]
    # a short item is found by its very words in a row, also where two cells meet
    docs += [(404, f"{text(63)} ZOR vesma quaol {text(90)}", "s"), (405, f"{text(30)} zor quaol vesma {text(30)}", "s"), (406, "vesma quaol! zor", "s"), (407, "zor vesma (quaol)", "s")]
    planted += [(404, 34), (407, 34)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        set(planted),
    )


def test_decontamination(exam):
    docs, items, planted = exam
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == planted
    kept = decontaminate.clean(docs, items)
    assert kept.schema == docs.schema
    bad = {d for d, _ in planted}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in docs.collect() if r.doc_id not in bad)))


def test_scores_are_those_of_every_passage_and_unit(exam):
    """Block maxima skip nothing: scores of all passages and units, without an index, give the same."""
    from earshot.llm.common import Words, text_chunks

    docs, items, _ = exam
    index = next(iter(decontaminate.indexes(items)))
    texts = [r.text for r in docs.collect()]
    import pyarrow as pa

    for first, last, data, offsets in text_chunks(pa.array(texts)):
        fast = {(d, u): s for d, u, s, *_ in decontaminate.hits(index, data, offsets)}
        words = Words(data, offsets, bare=True)
        slow = {}
        for d in range(last - first):
            own = words.hash[words.bounds[d] : words.bounds[d + 1]].view(np.int64)
            for a in range(0, len(own), decontaminate.UNIT):
                passage = own[a : a + 2 * decontaminate.UNIT]
                pairs = decontaminate._pairs(passage.view(np.uint64))
                terms = np.flatnonzero(np.isin(index.terms, passage))
                scores = np.zeros(len(index.items))
                for t in terms:
                    scores[index.unit[index.first[t] : index.first[t + 1]]] += index.impact[index.first[t] : index.first[t + 1]]
                for u in np.flatnonzero(scores >= decontaminate.LEAST_SCORE - 1e-9):
                    if index.exact[u] is not None:
                        body = index.exact[u].view(np.int64).tolist()
                        if any(passage[k : k + len(body)].tolist() == body for k in range(len(passage))):
                            slow[d, int(u)] = 1.0
                        continue
                    if np.isin(index.question[u], pairs).mean() >= decontaminate.LEAST_QUESTION and np.isin(index.answer[u], pairs).mean() >= decontaminate.LEAST_ANSWER:
                        slow[d, int(u)] = max(slow.get((d, int(u)), 0), scores[u])
        assert fast.keys() == slow.keys()
        assert all(abs(fast[k] - slow[k]) < 1e-9 for k in fast)


def test_index_in_shards_finds_the_same(exam):
    docs, items, planted = exam
    assert len(list(decontaminate.indexes(items, most=300))) > 2
    one = decontaminate.units(items).count()
    assert sum(len(i.items) for i in decontaminate.indexes(items, most=300)) == one


def test_decontamination_of_empty_tables(exam):
    docs, items, _ = exam
    assert decontaminate.contaminated(docs.limit(0), items).count() == decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count() and decontaminate.clean(docs.limit(0), items).count() == 0


# -- pipeline


def test_pipeline(spark, speech, tmp_path):
    import corpus_pipeline
    from earshot.llm import packing

    rng = random.Random(0)
    rows = [(r.doc_id, r.text, r.lang, "s", None if r.text is None else len(r.text)) for r in speech.collect() if r.doc_id is not None and r.doc_id < 300]
    rows += [(2000 + k, rows[k][1], rows[k][2], "s", rows[k][4]) for k in range(5)]
    fresh = lambda: " ".join("".join(rng.choice(["ka", "ti", "mo", "ne"]) for _ in range(3)) for _ in range(60))
    item = "tika mone kamo tine moka neti katine momo. neka timo kane tomo."
    rows += [(3000, f"{fresh()} {item} {fresh()}", "aa", "s", 1), (3001, "12 34", "aa", "s", 5), (3002, None, None, "s", None)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "benchmark", "packing"]
    sizes = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        sizes.append({r.doc_id for r in docs.collect()})
    assert not {3001, 3002} & sizes[0] and 3000 in sizes[2] and 3000 not in sizes[3]
    assert not {2000 + k for k in range(5)} & sizes[2] and len(sizes[3]) > 150
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == sizes[3]
    assert all(r.offset + r.length <= packing.CAPACITY for r in packed)
