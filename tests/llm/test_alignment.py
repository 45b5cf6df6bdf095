"""Cross-tokenizer alignment against a brute-force count over all links."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment
from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import byte_letters


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    path_a, path_b = alignment.default_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    letter = {c: k for k, c in enumerate(byte_letters())}

    def encoded(text):
        """(id, bytes) of both; None if either does not give the text back."""
        found = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(letter[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        two = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            byte = re.fullmatch("<0x(..)>", piece)
            two.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (one, two) if b"".join(x for _, x in one) == raw == b"".join(x for _, x in two) else None

    return encoded


def brute(texts, encoded):
    """Rows of the contract, by all pairs of byte ranges."""
    links, rows, count = [], [], Counter()
    for text in texts:
        both = encoded(text) if text else None
        own, groups = [], []
        if both:
            spans = []
            for side in both:
                at = 0
                spans.append([])
                for i, raw in side:
                    spans[-1].append((i, at, at + len(raw)))
                    at += len(raw)
            own = [(a, b) for a, s, e in spans[0] for b, t, f in spans[1] if s < f and t < e]
            start = 0
            for end in sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}):
                groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in spans))
                start = end
        links.append(own)
        count.update(own)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if both else ""
        rows.append([len(both[0]) if both else 0, len(both[1]) if both else 0, len(groups), len(own), digest])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(a, b, g, n, sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own), d)
            for (a, b, g, n, d), own in zip(rows, links)]


def _texts(n, seed):
    rnd = random.Random(seed)
    kinds = ["abcdefgh ", "the then  of\n", "aA'stre ve ll ", "éñüß œ", "한글漢字 ",
             "<|endoftext|> </s><s><unk>", "\t \n\x0b\x1c\x85 x　", "▁ a", "<0x0A> b", "0123 7", "#$%.,!", "🙂👍🏽 ", "é x", "\x00\x01 a"]
    for _ in range(n):
        words = "".join(rnd.sample(kinds, rnd.randrange(1, 4)))
        yield "".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))


def test_stretches_are_aligned_as_whole_texts(tokenizers):
    aligner = alignment.aligner(*alignment.default_paths())
    assert aligner.cut
    texts = [*_texts(3000, 1), "some words\n\nand lines \n of text  ", " leads", "\nleads", "don't we'll\nthey're", "a\n b", "a\tb c"]
    for text, found in zip(texts, aligner.align(texts)):
        assert found == aligner.whole(text), repr(text)


def test_links_groups_and_counts(spark, tokenizers):
    texts = [*_texts(150, 2), "the cat sat on the mat " * 20, None, "", "▁", "a▁b", "one", "one", "x" * 500, " ".join(_texts(40, 3))]
    rows = [(None if k % 9 == 0 else k // 2, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumns({"pair": F.lit("x"), "n_a": F.lit(1)})
    got = [tuple(r) for r in alignment.align(docs.repartition(3)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    want = [(d, *r) for (d, _), r in zip(rows, brute(texts, tokenizers))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert alignment.align(docs.limit(0)).count() == 0


def test_pair_counts_are_popcounts(spark):
    texts = ["the the the cat", "the cat", "cat"] * 30 + [None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id LONG, text STRING").coalesce(1)
    found = {(r["a"], r["b"]): (r["links"], r["documents"]) for r in alignment.pair_counts(alignment.inverted(docs)).collect()}
    assert sorted(found.values()) == [(90, 90), (120, 60)]


def test_bitmaps_keep_their_numbers():
    rng = np.random.default_rng(1)
    for size in (1, 7, 64, 5000, 1 << 16):
        for share in (0.001, 0.05, 0.5, 1):
            own = np.flatnonzero(rng.random(size) < share)
            packed = alignment._packed(own, size)
            assert alignment._unpacked(packed).tolist() == own.tolist() and len(packed) <= 1 + min(2 * len(own), (size + 7) // 8)


def test_blocks_end_where_they_are_full(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_POSTINGS", 3)
    block = alignment._Block(5)
    block.add(1, None)
    assert not block.full()
    block.add(None, (2, 2, 1, np.array([7, 7, 8, 9], np.int64).tobytes(), "1|2"))
    assert block.full()
    rows, postings = (b.to_pylist() for b in block.batches())
    assert [(r["doc_id"], r["n_links"]) for r in rows] == [(1, 0), (None, 4)]
    assert [(r["pair"], len(r["planes"])) for r in postings] == [(7, 1), (8, 0), (9, 0)]


def test_the_query_agrees_with_brute_force(spark, sf, tokenizers):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()
    small = spark.createDataFrame(docs)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(small).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    cut = [r["text"] for r in docs if len(r["text"]) < 4000]
    if len(cut) == len(docs):
        assert got == {r["doc_id"]: x for r, x in zip(docs, brute([r["text"] for r in docs], tokenizers))}
    assert QUERIES["op11_tokenizer_alignment"](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
