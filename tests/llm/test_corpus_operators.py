"""Sharding, near-duplicates, mixing and the pipeline, against brute force on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tidemark.llm import mixing, near_duplicates, sharding
from tidemark.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def edited(text, share, seed):
    rnd = random.Random(seed)
    return " ".join(f"new{rnd.randrange(10**6)}" if rnd.random() < share else w for w in text.split())


def shingle_set(text, size):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_components(rows, size, percent=80):
    """doc_id → (set size, least doc_id reachable); rows without id are nodes of their own."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if same or (common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common)):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        low[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in low.items()}
    return sorted((str(d), len(sets[i]), str(least[find(i)])) for i, (d, _) in enumerate(rows))


def near_rows():
    rows, base = [], prose(120, 1)
    rows += [(i, edited(base, 0.03, i)) for i in range(40)]  # a chain of near copies around the threshold
    rows += [(100 + i, edited(prose(60, 2), 0.012 * i, i)) for i in range(12)]
    rows += [(200 + i, prose(50, 50 + i)) for i in range(10)]
    rows += [(300, ""), (301, None), (302, " \n"), (303, "one"), (304, "ONE"), (305, "one two"), (306, "two one")]
    rows += [(400, prose(30, 9)), (400, prose(30, 9)), (401, prose(30, 9).upper()), (None, prose(30, 9)), (None, prose(25, 10)),
             (None, prose(25, 10)), (None, None)]
    rows += [(500, prose(4000, 11)), (501, edited(prose(4000, 11), 0.01, 1)), (502, edited(prose(4000, 11), 0.3, 1))]
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_components_of_near_copies(spark, size):
    rows = near_rows()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id LONG, text STRING, label STRING, node INT")
    got = near_duplicates.near_duplicates(docs, size=size).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows, size)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in got)
    if size == 5:
        kept = near_duplicates.keep_one_each(docs)
        want = {c for d, n, c in brute_components(rows, 5) if n and c != "None"}
        rest = [r for r in kept.collect() if r["text"] and r["text"].strip()]
        assert kept.columns == docs.columns and {str(r["doc_id"]) for r in rest if r["doc_id"] is not None} == want
        assert sum(r["doc_id"] is None for r in rest) == 1 and len(rest) == len(want) + 1  # one of the unnamed pair


def passage_rows(n):
    """Texts that share a passage and are no near-duplicates, and a few that are."""
    passage = prose(60, 77)
    rows = [(i, passage + " " + prose(28, 1000 + i)) for i in range(n)]
    near = [(10_000 + i, edited(rows[i][1], 0.03, i)) for i in range(0, n, 10)]
    return rows + near


def test_texts_that_share_a_passage_meet_by_their_rare_shingles(spark, monkeypatch):
    met, pairs_of = [], near_duplicates._member_pairs

    def watched(members, chosen, similarity):
        one = chosen.select("band", near_duplicates.F.col("node").alias("u"), near_duplicates.F.col("label").alias("p"))
        two = members.select("band", near_duplicates.F.col("node").alias("v"), near_duplicates.F.col("label").alias("q"))
        met.append(one.join(two, "band").filter("p != q").count())
        return pairs_of(members, chosen, similarity)
    monkeypatch.setattr(near_duplicates, "_member_pairs", watched)
    work = {}
    for n in (150, 300):
        met.clear()
        rows = passage_rows(n)
        docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
        got = near_duplicates.near_duplicates(docs, size=2).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows, 2)
        work[n] = sum(met)
    assert work[300] <= 2.5 * work[150] + 1000  # not four times


def test_texts_just_below_the_threshold_meet_by_what_the_smaller_one_needs(spark, monkeypatch):
    """Most of a text is the shared passage: its prefix reaches into it, what two of them can share does not."""
    met, pairs_of = [], near_duplicates._member_pairs

    def watched(members, chosen, similarity):
        one = chosen.select("band", near_duplicates.F.col("label").alias("p"))
        two = members.select("band", near_duplicates.F.col("label").alias("q"))
        met.append(one.join(two, "band").filter("p != q").count())
        return pairs_of(members, chosen, similarity)
    monkeypatch.setattr(near_duplicates, "_member_pairs", watched)
    work, passage = {}, prose(120, 78)
    for n in (200, 400):
        met.clear()
        rows = [(i, passage + " " + prose(20, 2000 + i)) for i in range(n)]
        rows += [(10_000 + i, edited(rows[i][1], 0.03, i)) for i in range(0, n, 10)]
        docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
        got = near_duplicates.near_duplicates(docs, size=2).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows, 2)
        work[n] = sum(met)
    assert work[400] <= 2.5 * work[200] + 1000  # not four times


def test_the_join_that_screens_pairs_can_be_compiled(spark, capsys):
    """The JVM interprets methods of more than 8,000 bytes."""
    rows = spark.createDataFrame([(1, i, i, 50, [i] * near_duplicates.SKETCH_LONGS) for i in range(3)],
                                 "band LONG, node LONG, label LONG, n_shingles LONG, sketch ARRAY<LONG>")
    pairs = near_duplicates._member_pairs(rows, rows, 0.8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no code before it runs
    try:
        pairs.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_empty_table_has_no_components(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert near_duplicates.near_duplicates(docs).collect() == []


def test_odd_sketches_tell_high_similarities():
    """At the threshold and above every pair passes; dissimilar pairs do not."""
    import math
    for n, seed in ((40, 1), (150, 2), (600, 3), (5000, 4)):
        text = prose(n, seed)
        one = near_duplicates.shingles(text.encode(), 2)
        for share in (0.0, 0.01, 0.03, 0.05, 0.3, 0.6):
            two = near_duplicates.shingles(edited(text, share, seed).encode(), 2)
            common = len(set(one.tolist()) & set(two.tolist()))
            jaccard = common / (len(one) + len(two) - common)
            a, b = (near_duplicates.odd_sketch(x) for x in (one, two))
            odd = sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a.tolist(), b.tolist()))
            sizes, k, bits = len(one) + len(two), near_duplicates.BOTTOM, near_duplicates.SKETCH_BITS
            t = min(1, k / max(len(one), len(two)))
            flips = min(len(one), k) + min(len(two), k) - 2 * t * common
            expected = bits / 2 * (1 - math.exp(-2 * flips / bits))
            assert abs(odd - expected) <= 6 * math.sqrt(max(4, expected)), (n, share, jaccard, sizes)


def test_shards_hold_near_equal_bytes(spark):
    rnd = random.Random(3)
    texts = [None, "", "é"] + [prose(rnd.randrange(1, 80), i) for i in range(400)] + ["same text of a hot group " * 3] * 300 + [prose(3000, 7)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "no id", "s"), (5, texts[5], "s"), (5, texts[5], "s")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, shard STRING")
    got = sharding.shard(docs).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(r["doc_id"]), r["_op4_size"], r["_op4_crc"]) for r in got) == sorted(
        (str(d), size(t), zlib.crc32((t or "").encode())) for d, t, _ in rows)
    bytes_of, slots = Counter(), defaultdict(list)
    for r in got:
        bytes_of[r["_op4_shard"]] += r["_op4_size"]
        slots[r["_op4_shard"]].append(r["_op4_slot"])
    largest = max(size(t) for t in texts)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(bytes_of) <= set(range(8)) and max(bytes_of.values()) - min(bytes_of[k] for k in range(8)) <= 2 * largest
    again = sharding.shard(docs).collect()
    assert sorted((str(r["doc_id"]), r["_op4_shard"], r["_op4_slot"]) for r in again) == sorted(
        (str(r["doc_id"]), r["_op4_shard"], r["_op4_slot"]) for r in got)
    assert sharding.shard(docs.limit(0)).collect() == []


def test_overfull_ranges_are_subdivided(spark):
    docs = spark.createDataFrame([(i, "one text for all") for i in range(3000)], "doc_id LONG, text STRING")
    rows = sharding._keys(docs, "doc_id", "text").select(sharding.SIZE, sharding.CRC, sharding.HASH, sharding.ID)
    _, totals = sharding.splitters(rows, 64, 1)
    assert totals["rows"].max() <= sharding.OVERFULL * 3000 / 64 and len(totals) >= 60


@pytest.mark.parametrize("seed", range(30))
def test_knapsack_finds_the_nearest_sum(seed):
    rnd = random.Random(seed)
    counts = {rnd.randrange(1, 40): rnd.randrange(1, 5) for _ in range(rnd.randrange(1, 6))}
    budget = rnd.randrange(0, 120)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    taken = mixing.knapsack(counts, budget)
    assert all(n <= counts[k] for k, n in taken.items())
    assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= budget)
    fitted = mixing.fit(counts, budget)
    assert all(n <= counts[k] for k, n in fitted.items()) and sum(k * n for k, n in fitted.items()) <= budget


def brute_targets(sizes):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    out, active, left = {}, set(names), sum(sizes.values())
    while active:
        level = left / sum(weight[n] for n in active)
        over = [n for n in active if level * weight[n] > 3 * sizes[n]]
        if not over:
            out.update({n: level * weight[n] for n in active})
            break
        for n in over:
            out[n] = 3 * sizes[n]
            active.discard(n)
            left -= 3 * sizes[n]
    return out


def test_mix_meets_its_targets(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd.randrange(1, 30), i), rnd.choice(["a", "b", "c", "é", "z", None])) for i in range(300)]
    rows += [(900 + i, prose(15, 77), "hot") for i in range(200)] + [(700, None, "a"), (701, "", "b"), (None, "x y", "c"), (5, rows[5][1], rows[5][2]),
             (702, prose(900, 1), "z"), (703, None, "wordless")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id LONG, text STRING, source STRING, size STRING")
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    want = brute_targets(sizes)
    plan = mixing.mix(docs).collect()
    assert sum(r["copies"] for r in plan) == len(rows)
    taken = Counter()
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]]) and r["passes"] <= 3
        taken[r["source"]] += r["size"] * r["copies"] * r["passes"]
    # The hot source has texts of 15 words only; the others meet their targets to a word.
    assert all(abs(taken[s] - want[s]) <= (15 if s == "hot" else 2) for s in sizes), (taken, want)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r["source"]] += len(WORDS.findall(r["text"] or ""))
    assert got == +taken
    assert mixing.mix(docs.limit(0)).collect() == []


def test_copies_of_a_document_are_taken_one_by_one(spark):
    """The second source may give 40 % of its thousand equal rows: alike but for another column."""
    rows = [(1, prose(2, 1), "a", 0), *((i, prose(10, 3), "b", i) for i in [None] * 1000)]
    rows = [(i, t, s, k) for k, (i, t, s, _) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, `a b` LONG").repartition(7)
    plan = mixing.mix(docs, weights=(1, 1)).collect()
    target = next(r["target"] for r in plan if r["source"] == "b")
    assert sum(r["copies"] for r in plan) == 1001
    assert abs(sum(r["size"] * r["copies"] * r["passes"] for r in plan if r["source"] == "b") - target) <= 10
    # Weights that leave a part of the rows: the first source, of 1,000 words, is given more than it has.
    rows = [(k, prose(1000, k), "a", k) for k in range(4)] + [(None, prose(10, 3), "b", k) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, `a b` LONG").repartition(7)
    plan = mixing.mix(docs, weights=(2, 1)).collect()
    target = next(r["target"] for r in plan if r["source"] == "b")
    taken = sum(r["size"] * r["copies"] * r["passes"] for r in plan if r["source"] == "b")
    assert 0 < taken and abs(taken - target) <= 10 and target < 5000
    got = mixing.mixed_documents(docs, weights=(2, 1)).filter("source = 'b'").collect()
    assert 10 * len(got) == taken and len({r["a b"] for r in got}) == len(got)


def test_pipeline_keeps_what_each_stage_decides(spark, sf):
    """Every stage on all that the one before kept, against brute force on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = near_duplicates.stored(stage(spark, docs, sf), "test-stage")
        after = docs.collect()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if k == 1:
            rows = [(r["doc_id"], r["text"]) for r in before]
            assert {r["doc_id"] for r in after} == {int(c) for _, _, c in brute_components(rows, 5)}
        if k == 2:
            token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
            fold = lambda t: token.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
            known = {tuple(w[i:i + 10]) for w in (fold(b["text"]) for b in bench) for i in range(max(1, len(w) - 9))}
            clean = [r["doc_id"] for r in before if not any(
                tuple(w[i:i + n]) in known for w in [fold(r["text"])] for n in {len(x) for x in known} for i in range(len(w) - n + 1))]
            assert sorted(r["doc_id"] for r in after) == sorted(clean)
        if k == 3:
            sizes = Counter()
            for r in before:
                sizes[r["source"]] += len(WORDS.findall(r["text"] or ""))
            got = Counter()
            for r in after:
                got[r["source"]] += len(WORDS.findall(r["text"]))
            want, longest = brute_targets(sizes), Counter()
            for r in before:
                longest[r["source"]] = max(longest[r["source"]], len(WORDS.findall(r["text"])))
            assert all(abs(got[s] - want[s]) <= longest[s] for s in sizes)  # few documents here: whole ones only
        if k == 4:
            assert Counter(r["doc_id"] for r in before) == Counter(r["doc_id"] for r in after)
            assert {r["shard"] for r in after} == set(range(8))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-duplicates", "benchmark decontamination", "mixing to target weights", "sharding"]


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = near_duplicates.stored(stage(spark, docs, sf), "empty-stage")
        assert docs.count() == 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op5_licence_scan", "op10_benchmark_decontamination"])
def test_query_matches_sql(spark, sf, name):
    import oracle

    from tidemark.llm.queries import SQL
    assert oracle.spark_rows(QUERIES[name](spark, sf)) == oracle.sql_rows(oracle.connect(sf), SQL[name])
