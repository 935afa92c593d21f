"""The queries of this folder and their SQL equivalents, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collision_ann,
    cover_tree,
    curriculum,
    decontaminate,
    language_id,
    license_scan,
    near_dedup,
    ppm,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_store,
    whitening,
)
from .shared import remainder_of_id, table

#: Vocabulary file of the token store, as ``public_tokenizers`` names it.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder_of_id("doc_id", 7) == 2
    scored = ppm.score_documents(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def license_sql(templates=license_scan.TEMPLATES, phrases=license_scan.PHRASES, percent: int = 90) -> str:
    """Every block of every text against every template, without prefixes or filters."""
    stride = max([license_scan.STRIDE, *[len(t.split()) for _, t in templates]])
    rows = ", ".join(
        f"({k}, '{label}', string_split('{' '.join(dict.fromkeys(t.split()))}', ' '))" for k, (label, t) in enumerate(templates)
    )
    place = " OR ".join(
        "(" + " AND ".join(f"w[i + {j}] = '{x}'" for j, x in enumerate(p.split(), 1)) + ")" for p, _ in phrases
    )
    named = "CASE " + " ".join(f"WHEN w[i + 1] = '{p.split()[0]}' THEN '{label}'" for p, label in phrases) + " END"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
t(number, label, words) AS (VALUES {rows}),
p AS (SELECT rid, i, {named} AS label FROM (SELECT rid, w, unnest(range(0, len(w))) AS i FROM d) WHERE {place}),
base AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM p GROUP BY rid),
b AS (SELECT rid, list_distinct(w[k * {stride} + 1 : k * {stride} + {2 * stride}]) AS block
      FROM (SELECT rid, w, unnest(range(0, (len(w) + {stride - 1}) // {stride})) AS k FROM d)),
h AS (SELECT rid, label, len(list_intersect(block, words)) AS n, len(words) AS size FROM b, t),
hits AS (SELECT rid, list(DISTINCT label) AS labels, max(n / size) AS score FROM h WHERE 100 * n >= {percent} * size GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ',') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN hits USING (rid)
"""


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


#: Every 200-byte window of the hex form by its digest; windows that occur again cover islands of bytes.
BYTES_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(coalesce(text, '')) AS h FROM documents),
w AS (
  SELECT rid, i, md5(substr(h, 2 * i + 1, 400)) AS g
  FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS n FROM w) WHERE n > 1),
m AS (SELECT rid, i, i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 200, -1) AS opens FROM r),
s AS (
  SELECT rid, min(i) AS lo, max(i) + 200 AS hi
  FROM (SELECT rid, i, count_if(opens) OVER (PARTITION BY rid ORDER BY i) AS k FROM m) GROUP BY rid, k),
c AS (
  SELECT rid, count(*) AS n, sum(hi - lo) AS removed, max(hi) AS last, string_agg(substr(h, 2 * past + 1, 2 * (lo - past)), '' ORDER BY lo) AS kept
  FROM (SELECT rid, h, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS past FROM s JOIN d USING (rid)) GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN c USING (rid)
"""


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: Links by joining shingles, components by reachability.
NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM d)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
pairs AS (SELECT x.rid AS a, y.rid AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.rid <> y.rid GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN n USING (rid) JOIN least USING (rid)
"""


def op6_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.plan_mix(table(spark, sf_dir, "documents"))
    first = F.when(F.size("positions") > 0, F.col("positions")[0])
    return plan.select("doc_id", "size", "source_size", "target", "taken", first.alias("position"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')), '0')) AS digest
  FROM documents),
s AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank
        FROM d GROUP BY source)),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, rank, source_size,
         least(lim, coalesce((SELECT level FROM l WHERE level * weight <= lim ORDER BY lim / weight, rank LIMIT 1) * weight, lim)) AS target
  FROM l),
c AS (
  SELECT d.doc_id, d.size, t.rank, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS INT) ELSE 1 END AS passes,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           + d.size / 2.0::DOUBLE AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, passes + CASE WHEN size > 0 AND middle < target - passes * source_size THEN 1 ELSE 0 END AS times,
         least(CASE WHEN target > 0 THEN middle / target ELSE 0.0 END, 1.0) AS u
  FROM c)
SELECT doc_id, size, source_size, target, CAST(times * size AS BIGINT) AS taken,
       CASE WHEN times = 0 THEN NULL ELSE round(CASE rank % 3
         WHEN 0 THEN (sqrt(greatest(2.25 - 2.0 * u, 0.0)) - 1.5) / -1.0
         WHEN 1 THEN u
         ELSE CASE WHEN u * 0.875 <= 0.25 THEN u * 0.875 / 0.5
              ELSE 0.5 + (sqrt(greatest(0.25 + (u * 0.875 - 0.25) * 6.0, 0.0)) - 0.5) / 3.0 END
       END, 9) END AS position
FROM p
"""


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digests(table(spark, sf_dir, "documents"))


#: The same over words: every window of 35 words by the digest of its words.
WORDS_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
x AS (
  SELECT rid, i, md5(array_to_string(w[i + 1 : i + 35], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(0, len(w) - 34)) AS i FROM d)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY g) AS n FROM x) WHERE n > 1),
m AS (SELECT rid, i, i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 35, -1) AS opens FROM r),
s AS (
  SELECT rid, min(i) AS lo, max(i) + 35 AS hi
  FROM (SELECT rid, i, count_if(opens) OVER (PARTITION BY rid ORDER BY i) AS k FROM m) GROUP BY rid, k),
c AS (
  SELECT rid, sum(hi - lo) AS removed, max(hi) AS last, flatten(list(w[past + 1 : lo] ORDER BY lo)) AS kept
  FROM (SELECT rid, w, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS past FROM s JOIN d USING (rid)) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_concat(coalesce(kept, []), w[coalesce(last, 0) + 1 :]), ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (rid)
"""


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, dictionary = token_store.write_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_store.read_documents(spark, folder, dictionary)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.fit_predict(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


#: Every anchor against every row; the products of integers are exact in doubles.
NEGATIVES_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * c::DOUBLE) for c in embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([c for c in embedding if c IS NOT NULL AND isfinite(c)]) = len(embedding)),
s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.rid <> b.rid AND len(a.x) = len(b.x)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) AS k FROM s WHERE same)
  WHERE k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other)::INTEGER AS rank
  FROM p JOIN s USING (anchor)
  WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
WHERE rank <= 3
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_ppm_score": op1_ppm_score,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_array": op3_suffix_array,
    "op4_decontaminate": op4_decontaminate,
    "op5_near_dedup": op5_near_dedup,
    "op6_mix_curriculum": op6_mix_curriculum,
    "op7_suffix_tree": op7_suffix_tree,
    "op8_token_store": op8_token_store,
    "op9_language_id": op9_language_id,
    "op10_collision_ann": op10_collision_ann,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op2_license_scan": license_sql(),
    "op3_suffix_array": BYTES_SQL,
    "op5_near_dedup": NEAR_SQL,
    "op6_mix_curriculum": MIX_SQL,
    "op7_suffix_tree": WORDS_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
}
