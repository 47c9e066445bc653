"""Repeated word windows and longest previous factors against brute force."""

import numpy as np
import pytest
from corpus import ODD, corpus, docs, empty, odd, with_clashes  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm.longest_factor import has_previous_factor, previous_smaller, remove_repeated_strings, seeds
from tidemill.llm.postings import Combiner
from tidemill.llm.token_windows import remove_repeated_windows, word_edges, word_hashes


def plain(rows, unit, size):
    """(units, covered places) of each row: a window that also starts under a smaller id goes."""
    cut = [(i, unit(t or "")) for i, t in rows]
    least = {}
    for i, units in cut:
        for a in range(len(units) - size + 1):
            key = tuple(units[a : a + size])
            least[key] = min(least.get(key, i), i)
    for i, units in cut:
        gone = [False] * len(units)
        for a in range(len(units) - size + 1):
            if least[tuple(units[a : a + size])] < i:
                gone[a : a + size] = [True] * size
        yield i, units, gone


@pytest.mark.parametrize("size", [13, 3])
def test_windows(docs, size):
    want = sorted(
        (i, len(u), sum(g), b" ".join(x for x, y in zip(u, g) if not y).decode())
        for i, u, g in plain(corpus(), lambda t: t.encode().split(), size)
    )
    got = remove_repeated_windows(docs, window=size)
    assert got.columns.count("n_words") == 1 and {"row", "rank", "th", "a.b"} <= set(got.columns)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == want
    for r in got.select("n_removed", "removed_spans").collect():
        assert sum(s.end - s.start for s in r.removed_spans) == r.n_removed


@pytest.mark.parametrize("length", [50, 8])
def test_strings(docs, length):
    want = sorted(
        (i, len(u), sum(g), bytes(x for x, y in zip(u, g) if not y)) for i, u, g in plain(corpus(), str.encode, length)
    )
    got = remove_repeated_strings(docs, length=length).select("doc_id", "n_bytes", "n_removed", "kept_bytes").collect()
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == want


@pytest.mark.parametrize("operator", [remove_repeated_windows, remove_repeated_strings])
def test_odd_rows(odd, empty, operator):
    rows = operator(odd).collect()
    assert len(rows) == len(ODD) and all(r.n_removed == 0 for r in rows)
    assert operator(empty).collect() == []


def test_rows_without_id_come_last(spark):
    text = " ".join(str(i) for i in range(60))
    got = remove_repeated_windows(with_clashes(spark, [(None, text), (3, text), (None, text + " x")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 60), (0, 60), (3, 0)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=1, max_size=40))
def test_previous_smaller(cells):
    rank = np.array([c[0] for c in cells])
    begins = np.array([i == 0 or c[1] for i, c in enumerate(cells)])
    got = previous_smaller(rank, begins)
    for i in range(len(cells)):
        start = max(j for j in range(i + 1) if begins[j])
        want = next((j for j in range(i - 1, start - 1, -1) if rank[j] < rank[i]), -1)
        assert got[i] == want


def test_factor_compares_zero_bytes():
    strings = np.array([b"a\x00\x01", b"a\x00\x01", b"a\x01\x01"], "S3")
    assert has_previous_factor(strings, np.array([2, 1, 3])).tolist() == [True, False, False]


def test_equal_strings_have_equal_seeds():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 256, 50).astype(np.uint8)
    a, b = (np.concatenate((rng.integers(0, 256, n).astype(np.uint8), shared, rng.integers(0, 256, 33).astype(np.uint8))) for n in (7, 91))
    assert seeds(a, 50)[7] == seeds(b, 50)[91]


def test_word_hashes_depend_on_the_word_only():
    data = np.frombuffer(b"one two\tone\n two  twoone", np.uint8)
    starts, ends = word_edges(data, np.array([0, 11, 24]))
    words = [bytes(data[a:b]) for a, b in zip(starts, ends)]
    assert words == [b"one", b"two", b"one", b"two", b"twoone"]
    h = word_hashes(data.tobytes(), starts, ends)
    assert len(set(h.tolist())) == 3 and h[0] == h[2] and h[1] == h[3]


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_a_polynomial_cannot_tell_apart(spark, size):
    """The Thue-Morse word and its complement agree under any odd base modulo 2^64."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(size))
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}"), (2, one.translate(str.maketrans("ab", "ba")) + " " + rest), (3, f"{one} {rest}")]
    got = remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 13}


def test_a_hot_hash_is_sent_about_once():
    """Ten steps of documents that all hold the same hash: later ones are settled in the task."""
    combiner = Combiner(4, need_earlier=True)
    sent = settled = 0
    for step in range(10):
        ids = np.arange(step * 50, step * 50 + 50)
        h = np.full(50, 77, np.uint64)
        for batch in combiner.step(h, np.arange(50), ids, ids, np.zeros(50, np.uint32)):
            for block, done in zip(batch.column("block"), batch.column("settled")):
                settled += done.as_py()
                sent += not done.as_py()
    assert sent == 1 and settled >= 10
