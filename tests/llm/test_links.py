"""Components, SimHash near-duplicates and near-equal lines against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from corpus import ODD, corpus, docs, empty, odd, prose, with_clashes  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import simhash
from tidemill.llm.components import Forest, components
from tidemill.llm.fuzzy_lines import _block_pairs, remove_similar_lines, signatures
from tidemill.llm.simhash import block_masks, keep_first, near_duplicates, near_links, planes_of, within


def classes(nodes, links):
    forest = Forest()
    for a, b in links:
        forest.link(a, b)
    return {n: forest.root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 400)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loose = [(rng.randrange(5000, 6000), rng.randrange(5000, 6000)) for _ in range(500)]
    links = chain + star + loose + [(7, 7), (3, 4), (4, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()}
    nodes = {n for link in links for n in link}
    want = classes(nodes, links)
    assert {n: got.get(n, n) for n in nodes} == want
    assert all(n != r for n, r in got.items())
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.integers(0, 7), st.integers(0, 2**64 - 1))
def test_bit_sliced_distances(values, radius, query):
    near = [values[0] ^ sum(1 << b for b in random.Random(i).sample(range(64), i % 9)) for i in range(20)]
    x = np.array([*values, *near], np.uint64)
    for q in (query, values[0]):
        want = np.bitwise_count(x ^ np.uint64(q)) <= radius
        assert (within(planes_of(x), len(x), radius, q) == want).all()


def test_blocks_miss_no_near_pair():
    rng = random.Random(8)
    for agree in (1, 2, 3, 4):
        masks = block_masks(agree + 4, agree)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not diff & m for m in masks)


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for j in range(64):
            counts[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * counts[j] > len(grams))


def plain_near(rows):
    prints = [plain_print(t) for _, t in rows]
    a = np.array(prints, np.uint64)
    links = [(i, j) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4).tolist()]
    roots = classes(range(len(rows)), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[roots[i]] = min(least.get(roots[i], doc), doc)
    return [(doc, f"{prints[i]:016x}", least[roots[i]]) for i, (doc, _) in enumerate(rows)]


def test_near_duplicates(spark, docs):
    got = near_duplicates(docs)
    assert sorted(tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()) == sorted(plain_near(corpus()))
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in plain_near(corpus())})


def test_near_groups_of_every_size(spark, monkeypatch):
    """Groups of near copies, small and large buckets alike, also when every bucket counts as large."""
    rng = random.Random(6)
    rows, n = [], 0
    for size in (1, 2, 3, 60):
        words = prose(rng, 400).split()
        for _ in range(size):
            own = list(words)
            own[rng.randrange(400)] = f"w{rng.randrange(99)}"
            rows.append((n, " ".join(own)))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(plain_near(rows))
    for large in (20_000, 1):
        monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
        assert sorted(tuple(r) for r in near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()) == want


def test_near_links_over_random_prints(spark):
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(40)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(30)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4).collect()
    a = np.array(sorted(values), np.uint64)
    plain = [(int(a[i]), int(a[j])) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)]
    name = lambda groups: {frozenset(n for n in groups if groups[n] == r) for r in groups.values()}
    got = classes([int(x) for x in a], [(r.u % (1 << 64), r.v % (1 << 64)) for r in links])
    assert name(got) == name(classes([int(x) for x in a], plain))


def test_near_odd_rows(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {7}
    assert near_duplicates(empty).collect() == [] and keep_first(empty).collect() == []
    assert sorted((r.doc_id or 0) for r in keep_first(odd).collect()) == [0, 7, 7]


def plain_lines(rows, shingle=8, least=0.8):
    order = sorted(((i, k, line.strip()) for i, t in rows for k, line in enumerate((t or "").encode().split(b"\n")) if line.strip()))
    texts = list(dict.fromkeys(t.decode() for *_, t in order))
    sets = [{x[i : i + shingle] for i in range(len(x) - shingle + 1)} for x in texts]
    links = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])
    ]
    roots = classes(range(len(texts)), links)
    first = {}
    for i, k, t in order:
        first.setdefault(roots[texts.index(t.decode())], (i, k))
    place = {t: roots[n] for n, t in enumerate(texts)}
    for i, t in rows:
        lines = (t or "").split("\n")
        cut = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
        gone = [k for k, x in enumerate(cut) if x and first[place[x]] != (i, k)]
        yield i, sum(map(bool, cut)), gone, "\n".join(x for k, x in enumerate(lines) if k not in gone)


def test_similar_lines(spark):
    rng = random.Random(12)
    base = [prose(rng, rng.randint(3, 40)) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(base).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(["Été", "x", "stone"])
            lines.append(rng.choice(["", "  "]) + " ".join(words) + rng.choice(["", "\t", "."]))
        rows.append((i, "\n".join([*lines, "", "The."])))
    rows += [(i + 100, t) for i, t in corpus() if i < 100]
    got = remove_similar_lines(with_clashes(spark, rows))
    found = sorted((r.doc_id, r.n_lines, r.removed_lines, r.kept_text) for r in got.collect())
    assert found == sorted(plain_lines(rows))
    assert all(r.n_removed == len(r.removed_lines) for r in got.collect())


def test_verification_of_small_and_large_buckets():
    from tidemill.llm import fuzzy_lines

    rng = random.Random(5)
    lines = []
    for _ in range(6):
        words = prose(rng, 30).split()
        for _ in range(15):
            own = list(words)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(30)] = f"w{rng.randrange(999)}"
            lines.append(" ".join(own))
    lines = list(dict.fromkeys(lines))
    nodes = list(range(len(lines)))
    found = []
    for verify in (fuzzy_lines._verify_many, fuzzy_lines._verify_bucket):
        fuzzy_lines.FEW_LINES = 12 if verify is fuzzy_lines._verify_many else 10_000
        forest = Forest()
        verify(nodes, lines, 8, 0.8, forest)
        found.append({n: forest.root(n) for n in nodes})
    fuzzy_lines.FEW_LINES = 12
    sets = [fuzzy_lines.shingles(x, 8) for x in lines]
    links = [(i, j) for i in nodes for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert found[0] == found[1] == classes(nodes, links)


def test_similar_lines_odd_rows(odd, empty):
    rows = remove_similar_lines(odd).collect()
    assert len(rows) == len(ODD) and remove_similar_lines(empty).collect() == []
    assert [r.kept_text for r in rows if r.text == "short text"] == ["short text"] * 2  # equal rows count once


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    errors = []
    for _ in range(30):
        a = prose(rng, 200)
        words = a.split()
        words[10:14] = ["quite", "other", "words", str(rng.random())]
        b = " ".join(words)
        sets = [{x[i : i + 8] for i in range(len(x) - 7)} for x in (a, b)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        sig = signatures([a, b], 8)
        errors.append((sig[0] == sig[1]).mean() - true)
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.3


def test_bands_miss_few_pairs():
    """Of pairs of similarity 0.8 no more miss each other than by 16 bands of 5."""
    from tidemill.llm import fuzzy_lines

    rng = random.Random(1)
    first = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(79)) for _ in range(10_000)]
    second = [x[:39] + "#" + x[40:] for x in first]
    assert fuzzy_lines.similarity(fuzzy_lines.shingles(first[0], 8), fuzzy_lines.shingles(second[0], 8)) == 0.8
    a, b = (fuzzy_lines.band_keys(signatures(x, 8)) for x in (first, second))
    assert (~(a == b).any(axis=1)).mean() <= (1 - 0.8**5) ** 16


def test_short_lines_with_one_changed_character(spark, tmp_path):
    """``op8_fuzzy_lines`` links lines from 49 characters on that differ in one of them, or in a number's last digit."""
    from tidemill.llm.queries import QUERIES

    rng = random.Random(7)
    first = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)).strip().ljust(n, "x") for n in (49, 52, 57, 64, 70, 78, 80)]
    second = [x[: len(x) // 2] + "#" + x[len(x) // 2 + 1 :] for x in first]
    first.append("Printed by the harbour office on 3 March, page 4 of 10 of the letter")
    second.append("Printed by the harbour office on 3 March, page 5 of 10 of the letter")
    rows = [(1, "\n".join(first)), (2, "\n".join(second) + "\nnothing like the others")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in QUERIES["op8_fuzzy_lines"](spark, str(tmp_path)).collect()}
    assert got == {1: (8, 0), 2: (9, 8)}


def test_any_two_members_of_a_large_bucket_meet(spark):
    from pyspark.sql import functions as F

    rows = [(n, 20_000) for n in range(-30, 30)] + [(n, 5) for n in range(3)]
    df = spark.createDataFrame(rows, "node long, size long").select("size", "node", _block_pairs(F.col("size"), F.col("node")).alias("b"))
    by_size = {}
    for r in df.collect():
        by_size.setdefault(r.size, []).append(set(r.b))
    for sets in by_size.values():
        assert all(a & b for a in sets for b in sets)


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "aé€😀 ", "".join(map(chr, range(32, 2500)))])
def test_sets_of_shingles_are_exact(alphabet):
    """Sets as numbers have the sizes and the intersections of sets of strings, also where 64 bits don't hold a shingle."""
    from tidemill.llm import fuzzy_lines

    rng = random.Random(len(alphabet))
    for shingle in (1, 5, 8, 13):
        lines = ["".join(rng.choice(alphabet) for _ in range(rng.choice([shingle, shingle + 1, 60]))) for _ in range(25)]
        lines += [lines[0], lines[-1] + "a"]
        cells, starts = fuzzy_lines.shingle_cells(pa.array(["not of them", *lines])[1:], shingle)
        found = [set(cells[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:])]
        sets = [fuzzy_lines.shingles(x, shingle) for x in lines]
        assert [len(x) for x in found] == np.diff(starts).tolist() == [len(x) for x in sets]
        assert all(len(found[i] & found[j]) == len(sets[i] & sets[j]) for i in range(len(sets)) for j in range(i))


@pytest.mark.parametrize("limits", [{}, {"TOGETHER_LINES": 6}, {"VERIFY_BYTES": 900}, {"VERIFY_LINES": 3, "VERIFY_PAIRS": 5}])
def test_buckets_of_a_least_line_are_verified_together(limits, monkeypatch):
    """All pairs that share a bucket, and no others, are linked if they are similar, however the rows are dealt to
    batches; buckets of an ordinary size need no sets of strings."""
    from tidemill.llm import fuzzy_lines

    for name, value in limits.items():
        monkeypatch.setattr(fuzzy_lines, name, value)
    if "TOGETHER_LINES" not in limits:
        monkeypatch.setattr(fuzzy_lines, "shingles", None)
    rng = random.Random(8)
    lines, rows, links = {}, [], []
    for key in range(40):
        words = prose(rng, 25).split()
        nodes = [key * 100 + i for i in range(rng.choice([2, 3, 9, 14]))]
        for node in nodes:
            own = list(words)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(25)] = rng.choice(["né", "w"]) + str(rng.randrange(999))
            lines[node] = " ".join(own)
        buckets = {b: sorted({nodes[0], *rng.sample(nodes, rng.randrange(1, len(nodes)))}) for b in range(key * 20, key * 20 + 3)}
        links += [(i, j) for b in buckets.values() for i in b for j in b if i < j]
        rows += [(key, n, lines[n], [b for b, members in buckets.items() if n in members]) for n in nodes if any(n in b for b in buckets.values())]
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("line", pa.string()), ("buckets", pa.list_(pa.int64()))])
    sets = {n: {x[i : i + 5] for i in range(len(x) - 4)} for n, x in lines.items()}
    true = classes(lines, [(i, j) for i, j in links if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])])
    assert 20 < len(set(true.values())) < len(lines)
    for step in (1, 7, len(rows)):
        batches = [pa.record_batch([*map(list, zip(*rows[a : a + step]))], schema=schema) for a in range(0, len(rows), step)]
        found = [x for b in fuzzy_lines._verify(5, 0.8)(batches) for x in zip(b.column("u").to_pylist(), b.column("v").to_pylist())]
        assert classes(lines, found) == true


def test_a_line_goes_once_to_the_buckets_of_a_least_line(spark):
    from pyspark.sql import functions as F

    from tidemill.llm.fuzzy_lines import _meetings

    rows = [(9, [(1, 11, 2), (1, 12, 5), (3, 13, 2), (1, 14, 9000)]), (8, [(3, 13, 2)])]
    df = spark.createDataFrame(rows, "node long, buckets array<struct<low: long, bucket: long, size: long>>")
    got = {r.node: r.m for r in df.select("node", _meetings(F.col("buckets"), F.col("node")).alias("m")).collect()}
    assert [(m.key, m.buckets) for m in got[8]] == [(3, [13])]
    assert [(m.key, sorted(m.buckets)) for m in got[9][:2]] == [(1, [11, 12]), (3, [13])]
    assert [m.buckets for m in got[9][2:]] == [[14]] * 3 and len({m.key for m in got[9]}) == 5  # 3 blocks, any two of which meet


def test_ends_of_lines(spark):
    """All white space of ASCII is cut from both ends, and no other."""
    long = "the pilots of the old harbour counted forty ships before the storm"
    cut = [long, f" {long}", f"{long}\t", f"\x0b{long}\r", f"\x0c \t{long} \x0c\x0b"]
    rows = [(i, f"{x}\n{chr(97 + i) * 20}") for i, x in enumerate(cut)] + [(10, "\xa0x\n \t\x0b\x0c\r\nx\n\x85x\nx "), (11, "x\n\xa0x ")]
    got = remove_similar_lines(spark.createDataFrame(rows, "doc_id long, text string"), shingle=5)
    found = {r.doc_id: (r.n_lines, r.removed_lines) for r in got.collect()}
    assert found == {0: (2, []), **{i: (2, [0]) for i in range(1, 5)}, 10: (4, [4]), 11: (2, [0, 1])}


def test_what_was_shuffled_is_removed_only_on_the_way(spark):
    from tidemill.plans.shared import shuffles_removed

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name) == before
    got = remove_similar_lines(spark.createDataFrame([(1, "a line\na line")], "doc_id long, text string").repartition(3, "doc_id"))
    assert spark.conf.get(name) == before
    assert [got.collect()[0].n_removed for _ in range(2)] == [1, 1]
