"""The registered query of each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    collocations,
    decontaminate,
    html_text,
    language,
    licences,
    mixing,
    near_duplicates,
    personal_data,
    quality,
    sharding,
    token_counts,
    toxicity,
)
from tidemark.llm.common import table

WORDS_SQL = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("failed_rule")


OP2_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS_SQL.format('text')} AS w
    FROM documents),
line AS (
    SELECT rid, s FROM (SELECT rid, unnest(string_split(t, chr(10))) AS s FROM docs)
    WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
lines AS (
    SELECT rid, count(*) - count(DISTINCT s) AS dup,
           sum(octet_length(encode(s))) - (SELECT sum(octet_length(encode(x.s))) FROM (SELECT DISTINCT rid, s FROM line) x WHERE x.rid = line.rid) AS dup_bytes
    FROM line GROUP BY rid),
place AS (
    SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
again AS (
    SELECT rid, unnest([i, i + 1, i + 2]) AS i FROM (
        SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM place) WHERE n > 1),
repeated AS (SELECT rid, count(DISTINCT i) AS n FROM again GROUP BY rid),
base AS (
    SELECT d.rid, d.doc_id, d.t, d.w, len(d.w) AS n_words,
           length(array_to_string(d.w, '')) AS word_chars,
           length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(l.dup, 0) AS n_dup_lines, coalesce(l.dup_bytes, 0) AS dup_bytes,
           coalesce(r.n, 0) AS n_repeat_words,
           octet_length(encode(regexp_replace(d.t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))) AS letters,
           length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g')) AS upper,
           len(list_filter(d.w, lambda x: regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]'))) AS plain
    FROM docs d LEFT JOIN lines l USING (rid) LEFT JOIN repeated r USING (rid)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 10 * dup_bytes <= 3 * octet_length(encode(t))
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * plain >= 7 * n_words
       AND 2 * upper <= letters AS kept
FROM judged"""


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"))

    def joined(kinds: Sequence[str]) -> Column:
        chosen = F.filter("spans", lambda s: s["kind"].isin(list(kinds)))
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, personal_data.BASE_KINDS), F.sha2(joined(personal_data.BASE_KINDS), 256).alias("base_sha256"),
                        joined(personal_data.KINDS).alias("spans"))


def op4_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_op4_size").alias("size"), F.col("_op4_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_op4_shard").alias("shard"), F.col("_op4_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``thousand/fifty/source/name``; the first of each fifty is the licence file
    of its folder, the first of each thousand that of the folder above."""
    number = F.col("doc_id")
    thousand, fifty = F.floor(number / 1000), F.floor(number / 50)
    path = F.when(F.pmod(number, F.lit(1000)) == 0, F.concat_ws("/", thousand, F.lit("LICENSE"))) \
        .when(F.pmod(number, F.lit(50)) == 0, F.concat_ws("/", thousand, fifty, F.lit("LICENSE"))) \
        .otherwise(F.concat_ws("/", thousand, fifty, F.coalesce("source", F.lit("-")), F.concat(number.cast("string"), F.lit(".txt"))))
    files = table(spark, sf_dir, "documents").select(number.alias("file"), path.alias("path"), "text")
    return licences.scan(spark, files).withColumnRenamed("file", "doc_id")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")) \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.training_texts(docs))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest_match")


OP10_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)),
item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
win AS (
    SELECT item_id, k, i - 1 AS off, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
        SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item WHERE len(w) > 0)),
place AS (
    SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
        SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT rid, item_id, p.i, p.k, p.i - off AS diagonal FROM place p JOIN win USING (k, s)),
words AS (SELECT rid, count(DISTINCT x) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS x FROM hit) GROUP BY rid),
items AS (
    SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY rid),
longest AS (
    SELECT rid, max(n) AS n FROM (
        SELECT rid, min(k) + count(*) - 1 AS n FROM (
            SELECT *, i - row_number() OVER (PARTITION BY rid, item_id, diagonal ORDER BY i) AS run FROM (SELECT DISTINCT * FROM hit))
        GROUP BY rid, item_id, diagonal, run) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated, coalesce(longest.n, 0) AS longest_match
FROM doc LEFT JOIN words USING (rid) LEFT JOIN items USING (rid) LEFT JOIN longest USING (rid)"""


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (
    SELECT rid, lang, row_number() OVER () AS pid, s FROM (
        SELECT rid, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS s FROM doc)),
word AS (
    SELECT lang, pid, unnest(w) AS w, unnest(range(len(w))) AS i FROM (
        SELECT lang, pid, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM piece)),
total AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
place AS (
    SELECT lang, w AS w1, lead(w, 1) OVER (PARTITION BY pid ORDER BY i) AS w2, lead(w, 2) OVER (PARTITION BY pid ORDER BY i) AS w3
    FROM word),
f AS (
    SELECT lang, k, p, count(*) AS n FROM (
        SELECT lang, 1 AS k, w1 AS p FROM place
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM place WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM place WHERE w3 IS NOT NULL)
    GROUP BY lang, k, p),
cand AS (
    SELECT *, split_part(p, ' ', 1) AS w1, split_part(p, ' ', 2) AS w2, split_part(p, ' ', 3) AS w3 FROM f WHERE k > 1 AND n >= 10),
inside AS (
    SELECT lang, p, max(n) AS n FROM (
        SELECT lang, w1 || ' ' || w2 AS p, n FROM cand WHERE k = 3 UNION ALL SELECT lang, w2 || ' ' || w3, n FROM cand WHERE k = 3)
    GROUP BY lang, p),
halves AS (
    SELECT lang, p, k, n, 1 AS j, w1 AS x, CASE k WHEN 2 THEN w2 ELSE w2 || ' ' || w3 END AS y FROM cand
    UNION ALL SELECT lang, p, k, n, 2, w1 || ' ' || w2, w3 FROM cand WHERE k = 3),
cut AS (
    SELECT h.lang, h.p, h.j, h.n AS a, fx.n AS l, fy.n AS r, (1000000::HUGEINT * h.n * h.n) // (fx.n::HUGEINT * fy.n) AS score
    FROM halves h JOIN f fx ON fx.lang = h.lang AND fx.p = h.x JOIN f fy ON fy.lang = h.lang AND fy.p = h.y),
scored AS (
    SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS nr FROM cut),
kept AS (
    SELECT s.lang, s.p AS phrase, s.a, s.l, s.r, CAST(s.score AS BIGINT) AS score
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.p = s.p WHERE s.nr = 1 AND (i.n IS NULL OR 100 * i.n < 50 * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, total.n AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


_NOTICE_ROWS = ",\n    ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licences.NOTICES))
OP5_SQL = rf"""
WITH notices(notice, licence, line) AS (VALUES {_NOTICE_ROWS}),
files AS (
    SELECT doc_id, text, CASE WHEN doc_id % 50 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS name,
           CASE WHEN doc_id % 1000 = 0 THEN CAST(doc_id // 1000 AS VARCHAR)
                WHEN doc_id % 50 = 0 THEN concat_ws('/', doc_id // 1000, doc_id // 50)
                ELSE concat_ws('/', doc_id // 1000, doc_id // 50, coalesce(source, '-')) END AS folder FROM documents),
split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
lines AS (SELECT doc_id, pos, regexp_extract_all(lower(line), '{licences.TERM}') AS terms FROM split
          WHERE regexp_matches(line, '{licences.CUE}')),
n AS (SELECT count(*) AS n FROM lines),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, pos, unnest(terms) AS term FROM lines) GROUP BY term),
side AS (
    SELECT doc_id AS a, pos AS b, 0 AS kind, unnest(terms) AS term FROM lines
    UNION ALL SELECT notice, 0, 1, unnest(regexp_extract_all(lower(line), '{licences.TERM}')) FROM notices),
weight AS (
    SELECT a, b, kind, term, count(*) * (ln((1.0 + any_value(n)) / (1 + coalesce(any_value(df), 0))) + 1) AS w
    FROM side LEFT JOIN df USING (term), n GROUP BY a, b, kind, term),
norm AS (SELECT a, b, kind, sqrt(sum(w * w)) AS norm FROM weight GROUP BY a, b, kind),
near AS (
    SELECT x.a AS doc_id, y.a AS notice, sum(x.w * y.w) / (any_value(p.norm) * any_value(q.norm)) AS score
    FROM weight x JOIN weight y ON x.term = y.term AND x.kind = 0 AND y.kind = 1
    JOIN norm p ON p.a = x.a AND p.b = x.b AND p.kind = 0 JOIN norm q ON q.a = y.a AND q.kind = 1
    GROUP BY x.a, x.b, y.a),
own AS (
    SELECT doc_id, licence, round(score, 4) AS score FROM near JOIN notices USING (notice) WHERE score >= {licences.LEAST_COSINE}
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 4) DESC, notice) = 1),
spoken AS (
    SELECT folder, licence FROM files JOIN own USING (doc_id) WHERE name = 'LICENSE'
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, doc_id) = 1)
SELECT f.doc_id, f.folder || '/' || f.name AS path, coalesce(o.licence, s.licence) AS licence,
       CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN s.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin, o.score
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN LATERAL (
    SELECT licence FROM spoken WHERE f.folder = spoken.folder OR starts_with(f.folder, spoken.folder || '/')
    ORDER BY length(spoken.folder) DESC LIMIT 1) s ON true"""

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_rules": op2_quality_rules,
    "op3_personal_data": op3_personal_data,
    "op4_sampled_splitters": op4_sampled_splitters,
    "op5_licence_scan": op5_licence_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_collocations": op12_collocations,
    "op13_token_counts": op13_token_counts,
}
SQL = {
    "op2_quality_rules": OP2_SQL,
    "op5_licence_scan": OP5_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op12_collocations": OP12_SQL,
}
