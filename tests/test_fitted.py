"""Newton regression, boosted trees and node tables against independent recomputation."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from adjudica.operators import ensembles, newton
from adjudica.operators.ensembles import BoostingSettings

SMALL = BoostingSettings(rounds=6, learning_rate=0.3, max_depth=2, min_rows=5)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    out = []
    for i in range(400):
        a, b, kind = float(rng.normal()), float(rng.integers(0, 12)), ["x", "y", "z", None][int(rng.integers(0, 4))]
        z = 1.5 * a - 0.2 * b + (1.0 if kind == "x" else 0.0)
        out.append((i, None if i % 17 == 0 else a, b, kind, int(rng.random() < 1 / (1 + math.exp(-z)))))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, kind string, y int").repartition(4).persist()


def features(frame):
    wide, made = ensembles.indicators(frame, ["kind"])
    return wide, made


def node_tables(model):
    trees = {}
    for tree, node, feature, threshold, value, n, _ in model.nodes:
        trees.setdefault(tree, {})[node] = (feature, threshold, value, n)
    return trees


def walk(tree, row):
    node = 1
    while tree[node][0] is not None:
        x = row[tree[node][0]]
        node = 2 * node if x is None or x <= tree[node][1] else 2 * node + 1
    return node


def test_indicators_of_values_and_gaps(frame):
    wide, made = features(frame)
    assert made == ["kind=x", "kind=y", "kind=z"]
    r = wide.where("kind is null").first()
    assert [r[m] for m in made] == [0.0, 0.0, 0.0]


def test_leaves_are_newton_steps_and_the_loss_is_that_of_the_margins(frame, rows):
    wide, made = features(frame)
    model = ensembles.fit_boosting(wide, "y", ["a", "b"], made, SMALL)
    data = [{"a": a, "b": b, **{f"kind={v}": float(k == v) for v in "xyz"}, "y": y} for _, a, b, k, y in rows]
    margins = np.full(len(data), model.start)
    ones = sum(r["y"] for r in data)
    assert model.start == pytest.approx(math.log(ones / (len(data) - ones)))
    y = np.array([r["y"] for r in data])
    for tree, nodes in sorted(node_tables(model).items()):
        loss = np.mean(np.logaddexp(0, margins) - y * margins)
        assert model.loss[tree] == pytest.approx(loss, abs=1e-8)
        p = 1 / (1 + np.exp(-margins))
        at = np.array([walk(nodes, r) for r in data])
        for node, (feature, _, value, n) in nodes.items():
            if feature is None:
                here = at == node
                assert n == here.sum() >= SMALL.min_rows
                assert value == pytest.approx(0.3 * (y - p)[here].sum() / (p * (1 - p))[here].sum(), abs=1e-7)
                margins[here] += value
    assert model.loss[-1] == pytest.approx(np.mean(np.logaddexp(0, margins) - y * margins), abs=1e-8)
    assert all(b < a for a, b in zip(model.loss, model.loss[1:]))


def test_root_splits_are_the_best_of_all(frame, rows):
    """The first tree's root against every feature and cut."""
    wide, made = features(frame)
    model = ensembles.fit_boosting(wide, "y", ["a", "b"], made, BoostingSettings(rounds=1, max_depth=1))
    binning = ensembles.Binning.fit(wide, ["a", "b"], made)
    y = np.array([r[4] for r in rows], float)
    g = y.mean() - y
    best = 0.0
    for name, cuts in binning.cuts.items():
        x = [r[1] if name == "a" else r[2] if name == "b" else float(r[3] == name[-1]) for r in rows]
        for c in cuts:
            left = np.array([v is None or v <= c for v in x])
            if 0 < left.sum() < len(y):
                gain = left.sum() * (~left).sum() / len(y) * (g[left].mean() - g[~left].mean()) ** 2
                best = max(best, gain)
    root = next(n for n in model.nodes if n[1] == 1)
    assert root[6] == pytest.approx(best, rel=1e-6)


def test_boosting_repeats_exactly_on_other_partitions(frame):
    wide, made = features(frame)
    one = ensembles.fit_boosting(wide, "y", ["a", "b"], made, SMALL)
    other = ensembles.fit_boosting(wide.repartition(7), "y", ["a", "b"], made, SMALL)
    assert one.nodes == other.nodes and one.loss == other.loss


def test_boosting_needs_both_classes(spark, frame):
    with pytest.raises(ValueError):
        ensembles.fit_boosting(frame.where("y = 1"), "y", ["a", "b"], [], SMALL)


def test_constant_features_give_single_leaves(spark):
    df = spark.createDataFrame([(1.0, i % 2) for i in range(20)], "a double, y int")
    model = ensembles.fit_boosting(df, "y", ["a"], [], BoostingSettings(rounds=2))
    assert [(n[0], n[1], n[2]) for n in model.nodes] == [(0, 1, None), (1, 1, None)]
    assert model.loss[-1] == pytest.approx(math.log(2))


#: Scores stored nodes: a step down all trees at once, until every row has reached a leaf.
SCORE_SQL = """
WITH RECURSIVE reached(id, tree, node) AS (
  SELECT id, tree, 1::BIGINT FROM data, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT r.id, r.tree, CASE WHEN x.value IS NULL OR x.value <= n.threshold THEN 2 * r.node ELSE 2 * r.node + 1 END
  FROM reached r JOIN nodes n USING (tree, node) LEFT JOIN long_ x ON x.id = r.id AND x.feature = n.feature
  WHERE n.feature IS NOT NULL)
SELECT id, {total} AS total FROM reached JOIN nodes USING (tree, node) WHERE nodes.feature IS NULL GROUP BY id ORDER BY id
"""


def scored_by_sql(nodes, wide, names, total):
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    con.register("data", wide.toPandas())
    long = " UNION ALL ".join(f"SELECT id, '{n}' AS feature, \"{n}\"::DOUBLE AS value FROM data" for n in names)
    con.sql(f"CREATE VIEW long_ AS SELECT * FROM ({long}) WHERE NOT isnan(value)")
    return dict(con.sql(SCORE_SQL.format(total=total)).fetchall())


def test_duckdb_scores_the_stored_boosted_nodes(spark, frame, tmp_path):
    wide, made = features(frame)
    names = ["a", "b", *made]
    model = ensembles.fit_boosting(wide, "y", ["a", "b"], made, SMALL)
    model.table(spark).write.parquet(str(tmp_path / "nodes"))
    nodes = spark.read.parquet(str(tmp_path / "nodes"))
    ours = {r.id: r.probability for r in ensembles.score(wide, nodes, names, model.start).collect()}
    theirs = scored_by_sql(nodes, wide, names, "sum(nodes.value)")
    assert len(ours) == len(theirs) == 400
    for i, total in theirs.items():
        assert ours[i] == pytest.approx(1 / (1 + math.exp(-(model.start + total))), abs=1e-12)


def test_node_table_of_a_saved_forest_gives_the_forests_probabilities(spark, frame, tmp_path):
    wide, made = features(frame.fillna(0.0, ["a"]))
    names = ["a", "b", *made]
    forest = RandomForestClassifier(labelCol="y", numTrees=12, maxDepth=5, minInstancesPerNode=5, seed=3)
    fitted = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), forest]).fit(wide)
    fitted.stages[-1].write().overwrite().save(str(tmp_path / "forest"))
    nodes = ensembles.forest_nodes(spark, str(tmp_path / "forest"), names).persist()
    assert nodes.select("tree").distinct().count() == 12
    expression = ensembles.margin(nodes, names, mean=True)
    both = fitted.transform(wide).select("id", vector_to_array("probability")[1].alias("p"), expression.alias("q")).collect()
    assert max(abs(r.p - r.q) for r in both) < 1e-9
    theirs = scored_by_sql(nodes, wide, names, "avg(nodes.value)")
    assert max(abs(r.p - theirs[r.id]) for r in both) < 1e-9


def test_too_many_nodes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ensembles, "MOST_NODES", 0)
    nodes = spark.createDataFrame([(0, 1, None, None, 0.5, 1, None)], ensembles.NODE_SCHEMA)
    with pytest.raises(ValueError):
        ensembles.margin(nodes, ["a"])


# --- regression -----------------------------------------------------------------------


def test_gradient_at_the_weights_is_zero(frame, rows):
    """The gradient of |w|^2 / 2 + C * loss recomputed in plain Python."""
    model = newton.fit_linear(frame, "y", ["a", "b"], ["kind"], C=0.5)
    assert [t[0] for t in model.terms] == ["(intercept)", "a", "b", "kind=x", "kind=y", "kind=z"]
    known = np.array([r[1] for r in rows if r[1] is not None])
    b = np.array([r[2] for r in rows])
    x = np.array([
        [1.0, 0.0 if r[1] is None else (r[1] - known.mean()) / known.std(), (r[2] - b.mean()) / b.std(), *[float(r[3] == v) for v in "xyz"]] for r in rows
    ])
    y = np.array([r[4] for r in rows])
    w = np.array([t[-1] for t in model.terms])
    p = 1 / (1 + np.exp(-(x @ w)))
    gradient = 0.5 * x.T @ (p - y) + np.concatenate([[0], w[1:]])
    assert np.abs(gradient).max() < 1e-7
    scored = {r.id: r.probability for r in model.score(frame).collect()}
    assert max(abs(scored[i] - q) for i, q in enumerate(p)) < 1e-9


def test_objective_falls_to_the_end(frame):
    wide, made = features(frame)
    fitted = newton.fit_newton(wide, "y", ["a", "b", *made])
    assert len(fitted.objective) < 12 and all(v <= u for u, v in zip(fitted.objective, fitted.objective[1:]))
    assert fitted.gradient < 1e-7


def test_separable_rows_and_constant_features_end(spark):
    df = spark.createDataFrame([(float(i), 1.0, int(i > 10)) for i in range(20)], "a double, one double, y int")
    fitted = newton.fit_newton(df, "y", ["a", "one"], C=100.0)
    assert fitted.gradient < 1e-5 and all(math.isfinite(w) for w in fitted.weights)


def test_model_table_survives_a_save(spark, frame, tmp_path):
    model = newton.fit_linear(frame, "y", ["a", "b"], ["kind"])
    model.save(spark, str(tmp_path / "m"))
    again = newton.LinearModel.load(spark, str(tmp_path / "m"))
    assert again.terms == model.terms
    new = spark.createDataFrame([(None, 3.0, "unseen")], "a double, b double, kind string")
    p = again.score(new).first().probability
    mean, scale = again.terms[2][3], again.terms[2][4]
    z = again.terms[0][-1] + again.terms[2][-1] * (3.0 - mean) / scale
    assert p == pytest.approx(1 / (1 + math.exp(-z)))
