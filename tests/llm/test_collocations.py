"""Phrase collocations against a count of all phrases."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import collocations


def brute(rows, first=2000, least=10, percent=50):
    total, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, count in f.items():
        cand = {p: n for p, n in count.items() if len(p) > 1 and n >= least}
        longer = [(p, n) for p, n in cand.items() if len(p) == 3]
        own = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * n >= percent * a and p in (q[:2], q[1:]) for q, n in longer):
                continue
            score, _, l, r = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), l, r))
        found += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:first])]
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame(rows, "lang STRING, text STRING").withColumns({"w1": F.lit(3), "n": F.lit("x")})


def prose(n, seed):
    rnd = random.Random(seed)
    words = ["a", "b", "Cc", "dd", "é", "Éa", "of the", "new york city", "x\ty", "-", "\xa0"]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "\x0c", "\r\n", "?!", ";:"]
    return "".join(rnd.choice(words) + rnd.choice(ends) for _ in range(n))


def rows_of_every_kind():
    rows = [(("en", "de", None, "und", "a\nb", "")[k % 6], prose(150, k)) for k in range(60)]
    rows += [("en", None), ("en", ""), ("en", " .\n"), ("en", "one"), ("de", ". ."), ("fr", "only once"), ("en", "tail b")]
    rows += [("xx", "hot pair " + f"n{k} w{k % 7}") for k in range(300)]  # one prefix with many followers
    rows += [("yy", "same text again and again. and again")] * 40
    return rows


def test_phrases_of_rows_of_every_kind(spark):
    rows = rows_of_every_kind()
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows)).collect())
    assert got == brute(rows)


def test_blocks_slices_and_wide_stripes_do_not_show(spark):
    rows = rows_of_every_kind()
    docs = table(spark, rows).repartition(5)
    for options in ({"wide": 3}, {"wide": 40, "bucket_bytes": 500}, {"block_words": 50, "bucket_bytes": 2000},
                    {"slice_words": 7, "wide": 2, "bucket_bytes": 3000}, {"slice_words": 1}):
        found = collocations.collocations(docs, **options)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows), options


def test_many_languages_and_words_fill_a_block(spark):
    rows = [(f"l{k % 150}", f"same phrase here {k}") for k in range(3000)]
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows).coalesce(1)).collect())
    assert got == brute(rows)


def test_first_rows_ties_and_large_products(spark):
    rows = [("en", " ".join(f"k{i} v{i}." for i in range(40)))] * 12
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, rows), first=7).collect())
    assert got == brute(rows, first=7) and len(got) == 7
    big = spark.sql("SELECT 4000000000000L a, 4000000000001L l, 4000000000003L r") \
        .select(collocations._score("a", "l", "r").alias("s")).first()["s"]
    assert big == 1000000 * 4000000000000 ** 2 // (4000000000001 * 4000000000003)


def test_an_empty_table_has_no_phrases(spark):
    assert collocations.collocations(table(spark, rows_of_every_kind()).limit(0)).count() == 0
