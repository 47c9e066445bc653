"""Quality rules, contamination and byte-level BPE against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from corpus import ODD, WORDS, corpus, docs, empty, odd, prose, with_clashes  # noqa: F401
from pyspark.sql import functions as F

from tidemill.llm import bpe
from tidemill.llm.decontaminate import contamination
from tidemill.llm.quality_rules import BASE, RULES, Rule, apply_rules, keep_good

PLAN = re.compile("Python|Pandas|Arrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def base_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen, places = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places |= {i + d for i in at for d in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(places) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(places), failed


def test_quality_measures(docs):
    got = apply_rules(docs)
    assert not PLAN.search(plan_of(got))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted((i, *base_measures(t)) for i, t in corpus())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want
    for r in got.select("base_failed", "kept", "failed_rules").collect():
        assert r.kept == (not r.failed_rules) and not (r.base_failed and r.kept)


def test_quality_verdicts(spark):
    rng = random.Random(2)
    good = "\n".join(prose(rng, 12) + "." for _ in range(10))
    junk = {
        "symbols": " ".join(w + "###" for w in prose(rng, 80).split()),
        "stop_words": " ".join(rng.choice("stone river bright harbour boats".split()) + str(i) for i in range(80)),
        "word_length": " ".join("a" for _ in range(100)),
        "repeated_lines": "\n".join(["the stone of the river"] * 30),
        "bullet_lines": "\n".join(f"- {prose(rng, 8)} {i}" for i in range(20)),
        "ellipsis_lines": "\n".join(f"{prose(rng, 8)} {i}..." for i in range(20)),
    }
    rows = [(0, good)] + [(i + 1, t) for i, t in enumerate(junk.values())]
    df = with_clashes(spark, rows)
    failed = {r.doc_id: r.failed_rules for r in apply_rules(df).collect()}
    assert failed[0] == []
    for i, name in enumerate(junk):
        assert name in failed[i + 1]
    kept = keep_good(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [0]
    own = keep_good(df, rules=[Rule("long", "n_words", at_most=99)], base=BASE)
    assert {r.doc_id for r in own.collect()} == {r.doc_id for r in apply_rules(df, rules=[Rule("l", "n_words", at_most=99)]).filter("kept").collect()}
    assert len(RULES) == 6


def test_quality_odd_rows(odd, empty):
    rows = apply_rules(odd).collect()
    assert len(rows) == len(ODD) and all(r.base_failed for r in rows)
    assert apply_rules(empty).collect() == [] and keep_good(empty).collect() == []


def plain_hits(text, items, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, gone, ids = cut(text), set(), set()
    for item, item_text in items:
        own = cut(item_text)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if own and tuple(words[i : i + size]) in grams:
                gone |= set(range(i, i + size))
                ids.add(str(item))
    return len(words), len(gone), sorted(ids), bool(gone) and 20 * len(gone) >= len(words)


@pytest.mark.parametrize("short", [True, False])
def test_contamination(spark, docs, short):
    passage = corpus()[7][1]
    items = [(1, passage), (22, " ".join(passage.split()[8:30]) + "."), (3, prose(random.Random(1), 25)), (4, None), (5, "")]
    if short:
        items += [(6, "Short, text"), (7, "again and again"), (8, "harbour")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs, bench)
    assert not PLAN.search(plan_of(got))
    want = sorted((i, *plain_hits(t, items)) for i, t in corpus())
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()) == want
    assert all(len(r.hit_words) == r.n_hit for r in got.collect())


def test_contamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(None, "short text"), (1, "short text"), (1, "no id here")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted(r.n_hit for r in contamination(odd, bench).collect()) == [0, 0, 2, 2, 3]
    assert all(r.items in ([], ["1"]) for r in contamination(odd, bench).collect())
    assert [r.n_hit for r in contamination(odd, none).collect()] == [0] * len(ODD)
    assert contamination(empty, bench).collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    return path, ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(vocabulary):
    keys = list(vocabulary[1])
    perfect = bpe.PerfectHash.build(keys)
    assert sorted(perfect.slot_key.tolist()) == list(range(len(keys)))
    assert perfect.lookup(perfect.hashes(keys)).tolist() == list(range(len(keys)))
    one = bpe.PerfectHash.build([b"only"])
    assert one.lookup(one.hashes([b"only", b"other"])).tolist() == [0, 0]


def test_merges_like_the_library(vocabulary):
    _, ranks, library = vocabulary
    tokens = list(ranks)
    own = bpe.Encoder(ranks, tokens, bpe.PerfectHash.build(tokens), public_tokenizers.PATTERN)
    rng = random.Random(5)
    pool = "abc  \t\n\x1c\x85\xa0 éßñ漢字1٣½²''s't're!?<|endoftext|>😀‍́ǅ\x00\x0b\r"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["a" * 3000, "ab" * 900]
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, np.uint32).tolist() == library.encode_ordinary(text)


def test_encode_and_decode(vocabulary, docs, odd, empty):
    path, _, library = vocabulary
    both = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path)
    got = sorted((r.doc_id, r.n_tokens, bytes(r.tokens), bytes(r.decoded)) for r in both.collect())
    want = sorted(
        (i, len(ids := library.encode_ordinary(t or "")), np.array(ids, "<u4").tobytes(), (t or "").encode()) for i, t in corpus()
    )
    assert got == want
    assert sorted(r.n_tokens for r in bpe.encode(odd, path, public_tokenizers.PATTERN).collect())[:2] == [0, 0]
    assert bpe.decode(bpe.encode(empty, path, public_tokenizers.PATTERN), path).collect() == []
    digest = both.select("doc_id", F.sha2("decoded", 256).alias("d")).collect()
    assert {r.d for r in digest} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in corpus()}
