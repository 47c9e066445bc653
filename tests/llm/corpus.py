"""A small corpus with every awkward kind of row, and the rules of the contracts in plain Python."""

import random

import pytest

WORDS = "the of and a river stone walks under bright morning carries letters toward quiet harbour where seven old boats wait".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus():
    """(doc_id, text): shared passages, copies, near copies, null, empty, blank, long, and repeated rows."""
    rng = random.Random(11)
    passage = " ".join(f"{rng.choice(WORDS)}{i}" for i in range(40))
    texts = [
        prose(rng, 80),
        passage + " " + prose(rng, 30),
        prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 5),
        None,
        "",
        " \t\n ",
        "short text",
        passage,
        passage + " end",
        prose(rng, 30) + " " + " ".join(passage.split()[5:25]),
        "Été à la plage — " + passage.replace("a", "é") + " ñandú 漢字 😀",
        ("again and again " * 700).strip(),
        prose(rng, 3000),
        "one line here that repeats itself\nsomething else entirely\none line here that repeats itself\n\n",
        "one line here that repeats itself!\nnothing of the kind",
        "x" * 5000,
        passage.upper(),
    ]
    texts.append(texts[0])
    rows = list(enumerate(texts))
    return rows + [(100, "tie " + prose(rng, 15)), (100, "tie " + passage)]


def with_clashes(spark, rows, schema="doc_id long, text string"):
    """The rows with further columns whose names the operators use themselves."""
    wide = ", row string, rank int, th string, hits int, n_words string, kept string, Words int, node long, `a.b` int"
    return spark.createDataFrame([(*r, "row", None, "x", 3, "none", "y", 1, 5, 2) for r in rows], schema + wide)


ODD = [(None, "no id here"), (None, None), (7, None), (7, "short text"), (7, "short text")]


@pytest.fixture
def docs(spark):
    return with_clashes(spark, corpus())


@pytest.fixture
def odd(spark):
    return with_clashes(spark, ODD)


@pytest.fixture
def empty(spark):
    return with_clashes(spark, [])
