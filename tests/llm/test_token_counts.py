"""Token counts of prefixes against the tokenizer library."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import token_counts as tc
from tidemark.llm.queries import QUERIES

KINDS = ["abcdefgh", "aaab", "aA'stremvld ", "é̈ aùñÑœ", "ｱ한글각ᄀ가", "<|endoftext|>a ",
         "०१क़़", "日本語、。", " 　x\x1c\x1f\x85y", "İIıſΣσςµß", "🙂👍🏽‍",
         "#$%.,!'\"<|>", "0123 x²", "̣́̇a e", "\x00\n\t b"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tc.default_path())
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def _texts(n, seed):
    rnd = random.Random(seed)
    for _ in range(n):
        letters = "".join(rnd.sample(KINDS, rnd.randrange(1, 4)))
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 30)))
        yield text if rnd.random() < 0.8 else text + rnd.choice(["<|endoftext|>", "<|startoftext|>", "they're"]) + text[:3]


def test_every_prefix_has_the_count_of_its_own_encoding(library):
    prefixes = tc.counter(tc.default_path())
    for text in _texts(1500, 3):
        assert prefixes.counts(text).tolist() == [library(text[:i + 1]) for i in range(len(text))], text


def test_windows_and_kept_spellings_do_not_show(library, monkeypatch):
    monkeypatch.setattr(tc, "WINDOW", 40)
    monkeypatch.setattr(tc, "KEPT", 20)
    monkeypatch.setattr(tc, "PREFIXES_KEPT", 30)
    prefixes = tc.PrefixCounts(tc.default_path())
    for text in _texts(300, 4):
        text = " ".join([text] * 9)
        assert prefixes.total(text) == library(text) and len(prefixes.counts(text)) == len(text)


def test_long_words_and_runs(library):
    prefixes = tc.counter(tc.default_path())
    for text in ("a" * 3000, "ab" * 2000, "'" * 500, "9" * 300, "é" * 700, "<|endoftext|>" * 50):
        assert prefixes.total(text) == library(text)


def test_rows_of_every_kind(spark, library):
    rows = [(1, "One two."), (1, "One two."), (None, "they're <|endoftext|>"), (2, None), (3, ""), (4, " \n"), (5, "x " * 2049)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("n_tokens", F.lit("theirs"))
    got = [tuple(r) for r in tc.token_counts(docs).collect()]
    want = [(d, len((t or "").encode()), library(t), library(t) > 2048) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert tc.token_counts(docs.limit(0)).count() == 0


def test_stored_prefixes_answer_without_encoding(spark, library):
    rows = [(k, t) for k, t in enumerate([*_texts(60, 5), "walking and talking " * 9, "", None])]
    stored = tc.with_prefixes(spark.createDataFrame(rows, "doc_id LONG, text STRING"))
    for r in stored.select("text", tc.chars_within(5).alias("n"), tc.tokens_of(7).alias("seven")).collect():
        text = r["text"] or ""
        fits = [i for i in range(len(text) + 1) if library(text[:i]) <= 5]
        assert r["n"] == max(fits) and r["seven"] == library(text[:7]), text
    cut = tc.truncated(stored, 5).select("text", "token_prefixes").collect()
    assert all(len(r["token_prefixes"]) == len(r["text"] or "") and library(r["text"]) <= 5 for r in cut)


def test_the_query_counts_as_the_library(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_token_counts"](spark, sf).collect()
    assert len(got) == len(texts)
    assert all(r["n_tokens"] == library(texts[r["doc_id"]]) and r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
