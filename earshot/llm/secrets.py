"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens. DataFrame functions only.

Patterns. ``assign``, ``access`` and ``hex`` are matched from the left, matches of a kind not overlapping. Places come from the
lengths of the matches and of the texts between them.

Battery. Candidates are runs of at least ``LEAST`` token characters with a letter and a digit. The narrowest alphabet that fits
is taken as a candidate's encoding: decimal, hexadecimal, base 32, lower-case base 36, base 62 or base 64. Three tests hold it
against random draws from that alphabet: chi-squared of the symbols' counts, the number of runs above and below the middle of
the alphabet, and serial correlation of neighbouring symbols. The smallest of the three p-values, times three, is its p-value.
Tests of short tokens say less, so the false discovery rate is held in each class of lengths by itself: the method of
Benjamini and Hochberg rejects randomness for tokens with small p-values (words, paths, identifiers made by people); what is
not rejected is reported as ``random``. The step-up works on counts of p-values in ``BINS`` fixed bins a class, so it is a small
aggregate at any size. A token inside a fixed pattern's match is not reported again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import Scratch

# The patterns of the three kinds, in their order. The last two have their least length in them: a run's first
# match that is long enough is the whole run, as it is without.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 12

LEAST = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{LEAST},}}"
FALSE_DISCOVERIES = 0.05
BINS = 400
BINS_PER_DECADE = 20

# The alphabets, each with its symbols in order.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ALPHABETS = (
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("", UPPER + LOWER + DIGITS + "+/-_"),
)


def _places(text: Column, pattern: str) -> Column:
    """Start, end and first characters' text of every match: array of (start, end, match), in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,body:string>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["body"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["body"].alias("body"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.transform(found, lambda body, i: F.struct(F.get(between, i).alias("gap"), body.alias("body")))
    return F.when(text.rlike(pattern), F.aggregate(pairs, zero, step)["out"]).otherwise(zero["out"])


def _spans(places: Column, kind: int) -> Column:
    return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Spans (start, kind, end) of the fixed patterns, by start, then kind."""
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(
        F.transform(_places(text, ASSIGN), lambda p, i: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.length(F.get(value, i)).alias("n"))),
        lambda p: p["n"] >= LEAST_VALUE,
    )
    return F.array_sort(F.concat(_spans(assign, 0), _spans(_places(text, ACCESS), 1), _spans(_places(text, HEX), 2)))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by a logistic curve (error under 2e-4; the far tail by its leading term)."""
    near = 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))
    far = F.exp(-z * z / 2) / (z * 2.5066282746)
    return F.when(z > 3, far).otherwise(near)


def tested(tokens: DataFrame) -> DataFrame:
    """Tokens (column ``body``) with their alphabet's size and the battery's p-value."""
    alphabet = None
    for pattern, symbols in ALPHABETS:
        if alphabet is None:
            alphabet = F.when(F.col("body").rlike(pattern), symbols)
        elif pattern:
            alphabet = alphabet.when(F.col("body").rlike(pattern), symbols)
        else:
            alphabet = alphabet.otherwise(symbols)
    rows = tokens.withColumn("alphabet", alphabet).withColumn("n", F.length("body").cast("double"))
    rows = rows.withColumn("size", F.length("alphabet").cast("double")).withColumn("symbols", F.filter(F.split("body", ""), lambda c: c != ""))
    rows = rows.withColumn("v", F.expr("transform(symbols, c -> CAST(locate(c, alphabet) AS DOUBLE))"))
    rows = rows.withColumn("squares", F.expr("aggregate(symbols, 0D, (s, c) -> s + n - length(replace(body, c, '')))"))
    rows = rows.withColumn("high", F.expr("transform(v, x -> x > size / 2)")).withColumn("ups", F.expr("CAST(size(filter(high, h -> h)) AS DOUBLE)"))
    rows = rows.withColumn("runs", F.expr("CAST(1 + size(filter(sequence(1, CAST(n AS INT) - 1), i -> high[i] != high[i - 1])) AS DOUBLE)"))
    rows = rows.withColumn("mean", F.expr("aggregate(v, 0D, (s, x) -> s + x) / n"))
    rows = rows.withColumn("variance", F.expr("aggregate(v, 0D, (s, x) -> s + (x - mean) * (x - mean))"))
    rows = rows.withColumn("lagged", F.expr("aggregate(sequence(1, CAST(n AS INT) - 1), 0D, (s, i) -> s + (v[i] - mean) * (v[i - 1] - mean))"))
    chi = (F.col("squares") * F.col("size") / F.col("n") - F.col("n") - F.col("size") + 1) / F.sqrt(2 * (F.col("size") - 1) * (1 - 1 / F.col("n")))
    expected = 2 * F.col("ups") * (F.col("n") - F.col("ups")) / F.col("n")
    spread = F.sqrt(expected * (expected - 1) / (F.col("n") - 1))
    runs = F.when(expected <= 1, F.lit(9.0)).otherwise(F.abs(F.col("runs") - 1 - expected) / spread)
    serial = F.when(F.col("variance") <= 0, F.lit(9.0)).otherwise(F.abs(F.col("lagged") / F.col("variance") * F.sqrt("n") + 1 / F.sqrt("n")))
    least = F.least(_normal_tail(chi), 2 * _normal_tail(runs), 2 * _normal_tail(serial))
    return rows.select(*tokens.columns, F.col("size").cast("int").alias("symbols"), F.greatest(F.least(3 * least, F.lit(1.0)), F.lit(1e-30)).alias("p"))


def not_rejected(tests: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Tokens whose randomness stands, with the false discovery rate held in each class of lengths."""
    length = F.floor(F.log2(F.length("body").cast("double")) * 2).cast("int")
    step = F.least(F.floor(-F.log10("p") * BINS_PER_DECADE), F.lit(BINS - 1)).cast("int")
    rows = tests.withColumn("class", length).withColumn("bin", step)
    counts = rows.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.partitionBy("class").orderBy(F.desc("bin"))
    steps = counts.withColumn("upto", F.sum("n").over(smaller)).withColumn("total", F.sum("n").over(Window.partitionBy("class")))
    # the largest p-values of a bin are just under 10 ** (-bin / BINS_PER_DECADE)
    passed = steps.where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= rate * F.col("upto") / F.col("total"))
    limit = passed.groupBy("class").agg(F.min("bin").alias("limit"))
    return rows.join(F.broadcast(limit), "class", "left").where(F.col("limit").isNull() | (F.col("bin") < F.col("limit"))).drop("class", "bin", "limit")


def scan(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per row doc_id, counts of each kind, the digest of the fixed kinds' spans, and all spans as text.

    A null text is an empty one, and has no spans. Every row is scanned by itself; rows equal in doc_id and text get equal
    results. Columns besides doc_id and text are not read. Spans are ``kind:start:end``, in code points, the end exclusive.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    token = F.filter(_places(F.col("text"), CANDIDATE), lambda p: p["body"].rlike("[0-9]") & p["body"].rlike("[A-Za-z]"))
    found = rows.select("doc_id", F.xxhash64("text").alias("digest"), base_spans(F.col("text")).alias("base"), token.alias("tokens"))
    found, _ = scratch.store(found, "spans")
    tokens = found.select("doc_id", "digest", "base", F.explode("tokens").alias("token")).select("doc_id", "digest", "base", "token.*")
    tokens = tokens.where(~F.exists("base", lambda b: (b["start"] <= F.col("start")) & (b["end"] >= F.col("end")))).drop("base")
    tests, _ = scratch.store(tested(tokens), "tests")
    random = not_rejected(tests, rate)
    one = F.struct(F.col("start"), F.lit(3).alias("kind"), F.col("end"))
    grouped = random.groupBy("doc_id", "digest").agg(F.collect_set(one).alias("random"))
    grouped = grouped.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "random")
    joined = found.drop("tokens").join(grouped, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left")
    all_spans = F.array_sort(F.concat("base", F.coalesce("random", F.array().cast(found.schema["base"].dataType))))

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")

    joined = joined.withColumn("all", all_spans)
    return joined.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
    )
