import random

import pytest

WORDS = [f"{a}{b}{c}" for a in ("ba", "ce", "di", "fo", "gu", "ha") for b in ("l", "m", "n", "r", "st") for c in ("a", "en", "is", "or", "um")]


def prose(rng, n, line=12):
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): copies, near copies, shared passages, repeated rows, nulls, empty and long texts, odd white space."""
    rng = random.Random(5)
    shared, line = prose(rng, 60, 60), prose(rng, 14, 14)
    rows = [(i, prose(rng, rng.randint(1, 120))) for i in range(40)]
    rows += [(40 + i, rows[i][1]) for i in range(6)]  # copies
    near = prose(rng, 100, 100)
    for i in range(12):  # near copies
        words = near.split(" ")
        for _ in range(i % 3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        rows.append((50 + i, " ".join(words)))
    rows += [(70 + i, f"{prose(rng, 20)}\n{shared}\n{line}\n{prose(rng, 9)}") for i in range(6)]
    rows += [(80, line), (81, f"{line}\n{line}\n\n \n{line}"), (82, "aá" * 400), (83, "zz" * 500), (84, f"{shared} {shared}")]
    rows += [(90, None), (91, ""), (92, " \n\t "), (93, "one"), (93, "one"), (94, "Ünï cødé — 中文 <|endoftext|>\t\r\n x"), (None, rows[0][1]), (None, None)]
    rows += [(95, prose(rng, 3000)), (96, "a b c d"), (97, "A B c d")]
    rng.shuffle(rows)
    return rows


EXTRA = "doc_id long, text string, lang string, n_chars long, doc string, digest string, node string, `_key` int, n_lines string, row string, lines int"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names the operators also use."""
    rows = [(i, t, "en", None if t is None else len(t), "d", "g", None, 1, "n", None, 2) for i, t in corpus]
    return spark.createDataFrame(rows, EXTRA).repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
