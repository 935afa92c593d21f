"""Catalogue: models fitted on the labelled documents, each next to SQL that fits the same model anew.

The SQL shares nothing with the library: it runs Newton's method, and the growth of boosted trees, as recursive queries.
"""

from __future__ import annotations

from statistics import fmean, pstdev

from pyspark.sql import functions as F

from ..operators import ensembles, newton, sampling
from ..session import stored, work_dir
from ..streaming import runs
from .registry import query, table

NUMERIC, CATEGORICAL = ["n_chars"], ["lang", "source"]
PENALTIES = (0.1, 1.0, 10.0)
FOLDS = 5


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    return stored(table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id"), "labelled-documents")


# --- regression by Newton steps ---------------------------------------------------

_BASE = """
  base AS (SELECT doc_id, quality::DOUBLE AS y, lang, source, n_chars::DOUBLE AS c FROM labels JOIN documents USING (doc_id))"""


def newton_sql(train: str, penalty: str, rounds: int = 14) -> str:
    """CTEs up to weights(g, w): a regression for each g of train(g, doc_id, y, lang, source, c) and penalty(g, lam).

    A round is one step to build the augmented normal equations, one a column to eliminate it, and one to move.
    """
    return f"""
  {_BASE},
  train AS ({train}),
  penalty AS ({penalty}),
  stat AS (SELECT g, avg(c) AS mean, stddev_pop(c) AS scale FROM train GROUP BY g),
  names AS (SELECT g, kind, value, row_number() OVER (PARTITION BY g ORDER BY kind, value) + 2 AS j FROM (
    SELECT DISTINCT g, 1 AS kind, lang AS value FROM train WHERE lang IS NOT NULL
    UNION ALL SELECT DISTINCT g, 2, source FROM train WHERE source IS NOT NULL)),
  dims AS (SELECT g, max(j) AS p FROM names GROUP BY g),
  x AS (
    SELECT g, doc_id, 1 AS j, 1.0::DOUBLE AS v FROM train
    UNION ALL SELECT g, doc_id, 2, (c - mean) / scale FROM train JOIN stat USING (g)
    UNION ALL SELECT t.g, doc_id, j, 1.0::DOUBLE FROM train t JOIN names n
      ON t.g = n.g AND ((kind = 1 AND lang = value) OR (kind = 2 AND source = value))),
  state(n, g, w, m) AS (
    SELECT 0, g, [0.0::DOUBLE for i in range(p)], [[0.0::DOUBLE]] FROM dims
    UNION ALL
    SELECT * FROM (
      WITH cur AS (SELECT n, g, w, m, p, lam, n % (p + 2) AS phase FROM state JOIN dims USING (g) JOIN penalty USING (g) WHERE n < {rounds} * (p + 2)),
      pr AS (SELECT cur.g, t.doc_id, any_value(t.y) AS y, 1 / (1 + exp(-sum(x.v * cur.w[x.j]))) AS q
        FROM cur JOIN train t ON t.g = cur.g JOIN x ON x.g = t.g AND x.doc_id = t.doc_id WHERE phase = 0 GROUP BY cur.g, t.doc_id),
      h AS (SELECT pr.g, a.j, b.j AS k, sum(q * (1 - q) * a.v * b.v) AS s
        FROM pr JOIN x a ON a.g = pr.g AND a.doc_id = pr.doc_id JOIN x b ON b.g = pr.g AND b.doc_id = pr.doc_id GROUP BY pr.g, a.j, b.j),
      gr AS (SELECT pr.g, a.j, sum((q - y) * a.v) AS s FROM pr JOIN x a ON a.g = pr.g AND a.doc_id = pr.doc_id GROUP BY pr.g, a.j),
      cells AS (SELECT cur.g, j, k,
          CASE WHEN k <= p THEN coalesce(h.s, 0) + CASE WHEN j = k AND j > 1 THEN lam ELSE 0 END
               ELSE coalesce(gr.s, 0) + CASE WHEN j > 1 THEN lam * w[j] ELSE 0 END END AS s
        FROM (SELECT *, unnest(range(1, p + 2)) AS k FROM (SELECT *, unnest(range(1, p + 1)) AS j FROM cur WHERE phase = 0)) cur
        LEFT JOIN h USING (g, j, k) LEFT JOIN gr USING (g, j)),
      mats AS (SELECT g, list(r ORDER BY j) AS built FROM (SELECT g, j, list(s ORDER BY k) AS r FROM cells GROUP BY g, j) GROUP BY g)
      SELECT n + 1, g,
        CASE WHEN phase = p + 1 THEN [w[i] - m[i][p + 1] for i in range(1, p + 1)] ELSE w END,
        CASE WHEN phase = 0 THEN built WHEN phase <= p THEN
          [[CASE WHEN i = phase THEN m[i][k] / m[i][i] ELSE m[i][k] - m[i][phase] * m[phase][k] / m[phase][phase] END
            for k in range(1, p + 2)] for i in range(1, p + 1)] ELSE m END
      FROM cur LEFT JOIN mats USING (g))),
  weights AS (SELECT g, max_by(w, n) AS w FROM state GROUP BY g)"""


_ALL = newton_sql("SELECT 1 AS g, * FROM base", "SELECT 1 AS g, 1.0::DOUBLE AS lam")


@query(
    "lr_newton_fit",
    f"""
    WITH RECURSIVE {_ALL}
    SELECT 0 AS position, '(intercept)' AS feature, round(w[1], 6) AS weight FROM weights
    UNION ALL SELECT 1, 'n_chars', round(w[2], 6) FROM weights
    UNION ALL SELECT (j - 1)::INTEGER, CASE kind WHEN 1 THEN 'lang=' ELSE 'source=' END || value, round(w[j], 6)
      FROM names JOIN weights USING (g)
    """,
)
def lr_newton_fit(spark, sf):
    """Weights of a regression on the labelled documents."""
    model = newton.fit_linear(labelled(spark, sf), "quality", NUMERIC, CATEGORICAL)
    return model.table(spark).select("position", "feature", F.round("weight", 6).alias("weight"))


_SCORE = f"""
    WITH RECURSIVE {_ALL},
    scored AS (SELECT doc_id, 1 / (1 + exp(-(w[1] + w[2] * coalesce((n_chars - mean) / scale, 0) + coalesce(a.j_w, 0) + coalesce(b.j_w, 0)))) AS p
      FROM documents d JOIN weights ON true JOIN stat USING (g)
      LEFT JOIN (SELECT value, w[j] AS j_w FROM names JOIN weights USING (g) WHERE kind = 1) a ON a.value = lang
      LEFT JOIN (SELECT value, w[j] AS j_w FROM names JOIN weights USING (g) WHERE kind = 2) b ON b.value = source)
    SELECT doc_id, round(p, 6) AS probability, (round(p, 9) >= 0.5)::INTEGER AS prediction FROM scored"""


def _reloaded(spark, sf):
    """The fitted model through its stored table."""
    path = work_dir(spark, "linear-model")
    newton.fit_linear(labelled(spark, sf), "quality", NUMERIC, CATEGORICAL).save(spark, path)
    return newton.LinearModel.load(spark, path)


def _decided(model, docs):
    return model.score(docs).select(
        "doc_id", F.round("probability", 6).alias("probability"), (F.round("probability", 9) >= 0.5).cast("int").alias("prediction")
    )


@query("lr_newton_score", _SCORE)
def lr_newton_score(spark, sf):
    """All documents, labelled or not, scored by the stored model."""
    return _decided(_reloaded(spark, sf), table(spark, sf, "documents"))


@query("stream_newton_scoring", _SCORE)
def stream_newton_scoring(spark, sf):
    """The documents as a stream, scored by the stored model."""
    return runs.run_to_table(_decided(_reloaded(spark, sf), runs.file_stream(spark, sf, "documents.parquet")), "stream-newton")


_FOLDS_SQL = """
  folded AS (SELECT doc_id, min(fold)::INTEGER AS fold FROM (
      SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY md5(doc_id::VARCHAR || '|42'), doc_id) AS rk FROM base) r
    JOIN (SELECT y, fold, sum(count(*)) OVER (PARTITION BY y ORDER BY fold) AS upto FROM (
        SELECT y, place % 5 AS fold FROM (SELECT y, count(*) AS n, coalesce(sum(count(*)) OVER (
          ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM base GROUP BY y) t,
        unnest(range(off::BIGINT, (off + n)::BIGINT)) AS u(place)) GROUP BY y, fold) b ON b.y = r.y AND rk <= upto
    GROUP BY doc_id)"""
_GROUPS = f"(SELECT unnest(range({len(PENALTIES) * FOLDS})) AS g)"


@query(
    "cv_newton",
    f"""
    WITH RECURSIVE {newton_sql(
        f"SELECT g, base.* FROM {_GROUPS} JOIN base ON true JOIN folded USING (doc_id) WHERE fold <> g % {FOLDS}",
        f"SELECT g, 1 / [{', '.join(f'{c}::DOUBLE' for c in PENALTIES)}][g // {FOLDS} + 1] AS lam FROM {_GROUPS}",
    ).replace("train AS (", _FOLDS_SQL.strip() + ", train AS (", 1)},
    held AS (SELECT g, doc_id, y, round(1 / (1 + exp(-(w[1] + w[2] * (c - mean) / scale + coalesce(w[a.j], 0) + coalesce(w[b.j], 0)))), 9) AS p
      FROM weights JOIN folded ON fold = g % {FOLDS} JOIN base USING (doc_id) JOIN stat USING (g)
      LEFT JOIN names a ON a.g = weights.g AND a.kind = 1 AND a.value = lang
      LEFT JOIN names b ON b.g = weights.g AND b.kind = 2 AND b.value = source),
    ranked AS (SELECT g, y, rank() OVER (PARTITION BY g ORDER BY p) + (count(*) OVER (PARTITION BY g, p) - 1) / 2.0::DOUBLE AS r FROM held),
    area AS (SELECT g, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)) AS auc FROM ranked GROUP BY g),
    means AS (SELECT g // {FOLDS} AS k, avg(auc) AS mean, stddev_pop(auc) AS std FROM area GROUP BY 1)
    SELECT [{', '.join(f'{c}::DOUBLE' for c in PENALTIES)}][k + 1] AS penalty, round(mean, 6) AS cv_mean, round(std, 6) AS cv_std,
      row_number() OVER (ORDER BY round(mean, 9) DESC, k) = 1 AS best FROM means
    """,
)
def cv_newton(spark, sf):
    """Three penalties, five stratified folds; the best by mean, the first one on ties."""
    folded = stored(sampling.stratified_folds(labelled(spark, sf), "quality", "doc_id", FOLDS, 42), "folded-documents")
    areas = newton.cross_validated_auc(folded, "quality", NUMERIC, CATEGORICAL, PENALTIES, FOLDS)
    means = [round(fmean(a), 9) for _, a in areas]
    rows = [(c, round(fmean(a), 6), round(pstdev(a), 6), means.index(max(means)) == i) for i, (c, a) in enumerate(areas)]
    return spark.createDataFrame(rows, "penalty double, cv_mean double, cv_std double, best boolean")


# --- boosted trees ------------------------------------------------------------------

BINS = 32


def boosting_sql(settings: ensembles.BoostingSettings = ensembles.BoostingSettings(), bins: int = BINS) -> str:
    """CTEs up to state(step, doc_id, y, margin, node, at_node, f, bin, value): every tree, level by level."""
    d, scale = settings.max_depth, f"{2.0 ** ensembles.FRACTION_BITS}::DOUBLE"
    parts = ", ".join(f"{k / bins}::DOUBLE" for k in range(1, bins))
    return f"""
  {_BASE},
  names AS (SELECT kind, value, row_number() OVER (ORDER BY kind, value) AS f FROM (
    SELECT DISTINCT 1 AS kind, lang AS value FROM base WHERE lang IS NOT NULL
    UNION ALL SELECT DISTINCT 2, source FROM base WHERE source IS NOT NULL)),
  cuts AS (SELECT list_sort(list_distinct(quantile_cont(c, [{parts}]))) AS cut FROM base),
  bins AS MATERIALIZED (
    SELECT doc_id, 0 AS f, len([u for u in cut if u < c]) AS bin FROM base, cuts
    UNION ALL SELECT doc_id, f, CASE WHEN (kind = 1 AND lang = value) OR (kind = 2 AND source = value) THEN 1 ELSE 0 END FROM base, names),
  state(step, doc_id, y, margin, node, at_node, f, bin, value) AS (
    SELECT 0, doc_id, y, (SELECT ln(sum(y) / sum(1 - y)) FROM base), 1::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM base
    UNION ALL
    SELECT * FROM (
      WITH cur AS (SELECT step, doc_id, y, margin, node, step % {d + 1} AS level, 1 / (1 + exp(-margin)) AS p
        FROM state WHERE step < {settings.rounds * (d + 1)}),
      gh AS (SELECT *, floor((p - y) * {scale} + 0.5)::BIGINT AS g, floor(p * (1 - p) * {scale} + 0.5)::BIGINT AS h FROM cur),
      cell AS (SELECT node, bins.f, bins.bin, sum(g) AS g, count(*) AS n FROM gh JOIN bins USING (doc_id)
        WHERE level < {d} AND node >= (1 << level) GROUP BY node, bins.f, bins.bin),
      cum AS (SELECT node, f, bin, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER t AS gt, sum(n) OVER t AS nt FROM cell
        WINDOW w AS (PARTITION BY node, f ORDER BY bin), t AS (PARTITION BY node, f)),
      apart AS (SELECT node, f, bin, gl * (nt - nl) - (gt - gl) * nl AS a, nl, nt FROM cum
        WHERE nl >= {settings.min_rows} AND nt - nl >= {max(settings.min_rows, 1)}),
      best AS (SELECT node, f, bin FROM (SELECT *, row_number() OVER (
          PARTITION BY node ORDER BY a::DOUBLE * a::DOUBLE / (nl * (nt - nl) * nt)::DOUBLE DESC, f, bin) AS k FROM apart WHERE a <> 0) WHERE k = 1),
      leaf AS (SELECT node, {settings.learning_rate}::DOUBLE * ((-sum(g))::DOUBLE / (sum(h)::DOUBLE + {settings.penalty}::DOUBLE * {scale})) AS value
        FROM gh WHERE level = {d} GROUP BY node)
      SELECT gh.step + 1, gh.doc_id, gh.y, CASE WHEN level = {d} THEN margin + leaf.value ELSE margin END,
        CASE WHEN level = {d} THEN 1 WHEN best.f IS NULL THEN gh.node ELSE 2 * gh.node + (bins.bin > best.bin)::BIGINT END,
        gh.node, best.f, best.bin, leaf.value
      FROM gh LEFT JOIN best ON best.node = gh.node LEFT JOIN bins ON bins.doc_id = gh.doc_id AND bins.f = best.f
      LEFT JOIN leaf ON leaf.node = gh.node))"""


_DEPTH = ensembles.BoostingSettings().max_depth


@query(
    "gbt_newton_fit",
    f"""
    WITH RECURSIVE {boosting_sql()},
    loss AS (SELECT step // {_DEPTH + 1} - 1 AS tree, avg(ln(1 + exp(-abs(margin))) + greatest(margin, 0) - y * margin) AS loss
      FROM state WHERE step > 0 AND step % {_DEPTH + 1} = 0 GROUP BY 1),
    found AS (
      SELECT (step - 1) // {_DEPTH + 1} AS tree, at_node AS node, f, bin, NULL::DOUBLE AS value, count(*) AS n FROM state
        WHERE f IS NOT NULL GROUP BY ALL
      UNION ALL SELECT (step - 1) // {_DEPTH + 1}, at_node, NULL, NULL, value, count(*) FROM state
        WHERE step > 0 AND step % {_DEPTH + 1} = 0 GROUP BY ALL)
    SELECT tree::INTEGER AS tree, node, CASE WHEN f = 0 THEN 'n_chars' ELSE CASE kind WHEN 1 THEN 'lang=' ELSE 'source=' END || names.value END AS feature,
      round(CASE WHEN f = 0 THEN cut[bin + 1] WHEN f > 0 THEN 0.5 END, 6) AS threshold, round(found.value, 6) AS value, n AS rows, round(loss, 6) AS loss
    FROM found JOIN loss USING (tree) JOIN cuts ON true LEFT JOIN names USING (f)
    """,
)
def gbt_newton_fit(spark, sf):
    """All nodes of all trees, with the training loss that each tree reaches."""
    wide, made = ensembles.indicators(labelled(spark, sf), CATEGORICAL)
    model = ensembles.fit_boosting(wide, "quality", NUMERIC, made, bins=BINS)
    loss = spark.createDataFrame(list(enumerate(model.loss[1:])), "tree int, loss double")
    return model.table(spark).join(loss, "tree").select(
        "tree", "node", "feature", F.round("threshold", 6).alias("threshold"), F.round("value", 6).alias("value"), "rows", F.round("loss", 6).alias("loss")
    )
