"""The alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus import docs, empty, odd, with_clashes  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemill.llm import alignment
from tidemill.llm.alignment import CSR, Aligner, ByteLevel, Pieces, align, link_rows, score_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """A function from a text to (A ids, B ids, groups, links, pairs that share a group)."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {v: k for k, v in alignment._bytes_of_letters().items()}
    back = {v: k for k, v in letters.items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        if not text:
            return [], [], [], [], 0
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx, by = [bytes(back[c] for c in a.id_to_token(i)) for i in x], [b_bytes(i) for i in y]
        if not b"".join(bx) == b"".join(by) == (" " + text).encode():
            return [], [], [], [], 0
        spans = []
        for pieces in (bx, by):
            at, own = 0, []
            for p in pieces:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [([], []) for _ in common]
        for side, (ids, own) in enumerate(zip((x, y), spans)):
            at = 0
            for i, (_, e) in zip(ids, own):
                groups[at][side].append(i)
                at += common[at] == e
        links = []
        j = 0
        for i, (s, e) in zip(x, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(y) and spans[1][k][0] < e:
                links.append((i, y[k]))
                k += 1
        return x, y, groups, links, sum(len(p) * len(q) for p, q in groups)

    return run


def as_text(groups):
    return ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)


def plain_scores(per_text):
    count = Counter(link for *_, links, _ in per_text for link in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links)) for *_, links, _ in per_text]


def check(spark_docs, plain):
    got = score_links(align(spark_docs, A, B)).collect()
    texts = [r["text"] for r in got]
    want = [plain(t) for t in texts]
    for r, (x, y, groups, links, shared), (best, total) in zip(got, want, plain_scores(want)):
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_shared"]) == (len(x), len(y), len(groups), len(links), shared)
        assert r["groups"] == as_text(groups) and (r["n_best"], r["count_sum"]) == (best, total)
    return got


def test_corpus(docs, plain):  # noqa: F811
    got = check(docs, plain)
    assert len(got) == docs.count() and "links" not in got[0].asDict() and got[0]["row"] == "row"


def test_links_and_packs(docs, plain):  # noqa: F811
    rows = align(docs, A, B).collect()
    assert all(sum(n for _, _, n in link_rows(r["links"])) == r["n_links"] for r in rows)
    assert len(check(docs.repartition(5), plain)) == len(rows)


def test_odd_rows(odd, empty, plain):  # noqa: F811
    assert len(check(odd, plain)) == 5
    assert score_links(align(empty, A, B)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab .,'-\n\t  ", "'s", "ß", "漢", "😀", "▁", " ", "́", "\x00", "<s>", "0x41", "9"]), max_size=40).map("".join))
def test_any_text(plain, text):
    aligner = made()
    counts, groups, links = aligner.align([text, text + " x", ""])
    for k, t in enumerate([text, text + " x", ""]):
        x, y, g, link, shared = plain(t)
        assert counts[k, :5].tolist() == [len(x), len(y), len(g), len(link), shared] and groups[k] == as_text(g)
        assert sorted(link_rows(links[k])) == sorted((*p, n) for p, n in Counter(link).items())


_MADE = []


def made():
    if not _MADE:
        with open(A) as a, open(B, "rb") as b:
            _MADE.append(Aligner(ByteLevel(a.read()), Pieces(b.read())))
    return _MADE[0]


def test_stretches():
    aligner = made()
    assert aligner.stretches and aligner.split(" a  b\n c\xa0 \xa0 d ") == [" a", "  b\n", " c\xa0 \xa0 d", " "]


def test_whole_texts_when_tokens_cross_blanks(plain):
    aligner = made()
    fast, aligner.split, aligner.stretches = aligner.split, alignment.re.compile("(?s).+").findall, False
    try:
        text = "several words  here,\nand <|endoftext|> more " * 20
        x, y, g, link, _ = plain(text)
        counts, groups, _ = aligner.align([text])
        assert counts[0, :4].tolist() == [len(x), len(y), len(g), len(link)] and groups[0] == as_text(g)
    finally:
        aligner.split, aligner.stretches = fast, True


def test_half_a_megabyte_without_blanks_and_with(spark, plain):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh019+/") for _ in range(1 << 19)), "some words " * 50_000]
    rows = with_clashes(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in align(rows, A, B).collect()}
    for i, t in enumerate(texts):
        x, y, g, link, _ = plain(t)
        assert (got[i]["n_a"], got[i]["n_b"], got[i]["n_groups"], got[i]["n_links"]) == (len(x), len(y), len(g), len(link))
        assert hashlib.sha256(got[i]["groups"].encode()).digest() == hashlib.sha256(as_text(g).encode()).digest()


def test_products(monkeypatch):
    rng = np.random.default_rng(2)
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(alignment, "BLOCK_ENTRIES", block)
        for _ in range(20):
            x, y = rng.integers(0, 3, (rng.integers(1, 9), 6)), rng.integers(0, 2, (6, rng.integers(1, 9)))
            got = np.zeros((len(x), y.shape[1]), np.int64)
            for i, j, v in sparse(x).times(sparse(y)):
                got[i, j] += v
            assert (got == x @ y).all()
            assert (dense(sparse(x).transposed(), len(x)) == x.T).all()


def sparse(m):
    r, c = np.nonzero(m)
    return CSR(np.concatenate(([0], np.cumsum((m > 0).sum(1)))), c, m[r, c], m.shape[1])


def dense(m, width):
    out = np.zeros((len(m.start) - 1, width), np.int64)
    for i in range(len(out)):
        out[i, m.cols[m.start[i] : m.start[i + 1]]] = m.data[m.start[i] : m.start[i + 1]]
    return out


def test_query_on_the_table(spark, sf, plain):
    from tidemill.llm.queries import op12_alignment

    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = [plain(r.text) for r in rows]
    got = op12_alignment(spark, sf).orderBy("doc_id").collect()
    for r, d, (x, y, g, links, _), (best, total) in zip(got, rows, want, plain_scores(want)):
        digest = hashlib.sha256(as_text(g).encode()).hexdigest() if x else ""
        assert (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links) == (d.doc_id, len(x), len(y), len(g), len(links))
        assert (r.n_best, r.count_sum, r.groups_sha256) == (best, total, digest)
