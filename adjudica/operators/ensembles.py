"""Tree ensembles as tables: binned features, gradient boosting with Newton leaves, and scoring of stored nodes.

An ensemble is a table of nodes (tree, node, feature, threshold, value, rows, gain). Nodes are numbered like a heap: the
root is 1, the children of n are 2n (value <= threshold, or missing) and 2n + 1. A leaf has a value and no feature. The table is
the model: any engine can score it, and ``margin`` turns it into one column expression without Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .quantiles import exact_quantiles

NODE_SCHEMA = "tree int, node long, feature string, threshold double, value double, rows long, gain double"

#: Bits behind the point of gradients and hessians: their sums are integers, which do not depend on the order of rows.
FRACTION_BITS = 30
#: Trees between two writes of the margins: a pass walks at most so many.
TREES_A_WRITE = 25
#: Rows of a task's share of the stored features, on average.
ROWS_A_TASK = 250_000
#: Tasks whose sums the driver adds up itself: a pass over a small table is then one stage.
FEW_TASKS = 8
#: Nodes of a model that fit an expression.
MOST_NODES = 2_000_000


# --- features -------------------------------------------------------------------


def indicators(df: DataFrame, categorical: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A 0/1 column ``name=value`` for each value of the categorical columns, in the order of the values.

    A missing value has 0 in all of them. The distinct values are read by the driver: they become columns.
    """
    if not categorical:
        return df, []
    seen = df.select(
        *[F.array_sort(F.collect_set(F.col(f"`{c}`").cast("string"))).alias(f"v{i}") for i, c in enumerate(categorical)]
    ).first()
    made = {f"{c}={v}": F.coalesce((F.col(f"`{c}`").cast("string") == v).cast("double"), F.lit(0.0)) for i, c in enumerate(categorical) for v in seen[i]}
    return df.withColumns(made), list(made)


@dataclass(frozen=True)
class Binning:
    """Cut points of each feature; the bin of a value is the number of cuts below it, that of a missing one is 0."""

    cuts: Mapping[str, Sequence[float]]

    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], indicator: Sequence[str] = (), bins: int = 32) -> Binning:
        """Numeric columns are cut at their exact quantiles k / bins, indicators between 0 and 1."""
        found = exact_quantiles(df, list(numeric), [k / bins for k in range(1, bins)])
        cuts = {c: sorted(set(found[c] or [])) for c in numeric}
        return cls({**cuts, **{c: [0.5] for c in indicator}})

    @property
    def features(self) -> list[str]:
        return list(self.cuts)

    def column(self) -> Column:
        """array<int> of the bins, in the order of the features."""
        return F.array(*[self._bin(c, cuts) for c, cuts in self.cuts.items()])

    @staticmethod
    def _bin(name: str, cuts: Sequence[float]) -> Column:
        value = F.col(f"`{name}`").cast("double")
        known = F.when(F.isnan(value), None).otherwise(value)
        if not cuts:
            return F.lit(0)
        if len(cuts) == 1:
            return F.coalesce((known > cuts[0]).cast("int"), F.lit(0))
        below = F.filter(F.lit(list(cuts)), lambda c: c < known)
        return F.when(known.isNull(), 0).otherwise(F.size(below))


# --- boosting -------------------------------------------------------------------


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 200
    learning_rate: float = 0.05
    max_depth: int = 3
    min_rows: int = 1
    #: Added to the sum of hessians of a leaf.
    penalty: float = 0.0


@dataclass
class _Part:
    """Sums of the rows of a node."""

    rows: int = 0
    g: int = 0
    h: int = 0

    def plus(self, rows, g, h) -> _Part:
        return _Part(self.rows + rows, self.g + g, self.h + h)

    def minus(self, other: _Part) -> _Part:
        return _Part(self.rows - other.rows, self.g - other.g, self.h - other.h)


@dataclass
class Split:
    feature: int
    bin: int
    gain: float
    left: _Part = field(repr=False)
    right: _Part = field(repr=False)


def best_split(histogram: Mapping[int, Mapping[int, _Part]], total: _Part, min_rows: int) -> Split | None:
    """The split with the largest reduction of the squared error of the gradients; ties go to the first feature, then bin.

    The reduction is rows_l * rows_r / rows * (mean_l - mean_r)^2. Its numerator is an integer, so equal splits have equal gains.
    """
    best = None
    for feature in sorted(histogram):
        left = _Part()
        for place in sorted(histogram[feature]):
            part = histogram[feature][place]
            left = left.plus(part.rows, part.g, part.h)
            right = total.minus(left)
            if left.rows < min_rows or right.rows < max(min_rows, 1):
                continue
            apart = left.g * right.rows - right.g * left.rows
            gain = float(apart) * float(apart) / float(left.rows * right.rows * (left.rows + right.rows))
            if apart and (best is None or gain > best.gain):
                best = Split(feature, place, gain, left, right)
    return best


class _Tree:
    """A tree, or the upper part of one, as arrays over node numbers."""

    def __init__(self, depth: int, splits: Mapping[int, Split], leaves: Mapping[int, float] = {}):
        self.depth = depth
        self.feature = np.full(2 << depth, -1, np.int64)
        self.bin = np.zeros(2 << depth, np.int64)
        self.value = np.zeros(2 << depth)
        for n, s in splits.items():
            self.feature[n], self.bin[n] = s.feature, s.bin
        for n, v in leaves.items():
            self.value[n] = v

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        at, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            feature = self.feature[at]
            right = bins[rows, np.maximum(feature, 0)] > self.bin[at]
            at = np.where(feature >= 0, 2 * at + right, at)
        return at


def _bins_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch["bins"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _moved(batch: pa.RecordBatch, bins: np.ndarray, trees: Sequence[_Tree]) -> np.ndarray:
    """Margins after the given trees."""
    margin = batch["margin"].to_numpy(zero_copy_only=False).copy()
    for t in trees:
        margin += t.value[t.nodes(bins)]
    return margin


def _after(work: DataFrame, trees: Sequence[_Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                margin = pa.array(_moved(batch, _bins_of(batch), trees))
                yield pa.record_batch([batch["y"], batch["bins"], margin], names=["y", "bins", "margin"])

    return work.mapInArrow(run, work.schema)


def _histogram(work: DataFrame, trees: Sequence[_Tree], upper: _Tree, level: Sequence[int], sizes: Sequence[int], scale: float, tasks: int) -> list:
    """(node, feature, bin, rows, g, h) of the nodes of a level; the row of feature -1 has the loss in ``g``.

    A task adds up all its rows before it sends a cell. The sums are integers: their order does not matter.
    """
    place = np.full(2 << upper.depth, -1, np.int64)
    place[list(level)] = np.arange(len(level))
    width = max(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(level) * len(sizes) * width), np.int64)
        lost, rows = 0, 0
        for batch in batches:
            if not len(batch):
                continue
            bins = _bins_of(batch)
            margin = _moved(batch, bins, trees)
            y = batch["y"].to_numpy(zero_copy_only=False)
            p = 1.0 / (1.0 + np.exp(-margin))
            fixed = [np.floor(v * scale + 0.5) for v in (p - y, p * (1.0 - p))]
            loss = np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0.0) - y * margin
            lost, rows = lost + int(np.floor(loss * scale + 0.5).sum()), rows + len(batch)
            node = place[upper.nodes(bins)]
            inside = node >= 0
            node, bins = node[inside], bins[inside]
            for feature in range(len(sizes)):
                cell = (node * len(sizes) + feature) * width + bins[:, feature]
                # a batch's sums stay exact in doubles
                for k, weights in enumerate((None, fixed[0][inside], fixed[1][inside])):
                    total[k] += np.bincount(cell, weights, total.shape[1]).astype(np.int64)
        found = np.flatnonzero(total[0])
        node, rest = np.divmod(found, len(sizes) * width)
        columns = [np.array(level, np.int64)[node], *np.divmod(rest, width), *total[:, found]]
        ends = [1, -1, 0, rows, lost, 0]
        yield pa.record_batch(
            [pa.array(np.append(c, e).astype(np.int64)) for c, e in zip(columns, ends)], names=["node", "feature", "bin", "rows", "g", "h"]
        )

    cells = work.mapInArrow(run, "node long, feature long, bin long, rows long, g long, h long")
    if tasks > FEW_TASKS:
        cells = cells.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("rows", "g", "h")])
    added: dict[tuple, _Part] = {}
    for r in cells.collect():
        added[r[:3]] = added.get(r[:3], _Part()).plus(*r[3:])
    return list(added.items())


@dataclass
class Ensemble:
    """Nodes of a fitted ensemble with its start value. ``loss`` is the mean training loss before each tree, and after the last."""

    start: float
    nodes: list[tuple]
    loss: list[float] = field(default_factory=list)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)


def fit_boosting(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    indicator: Sequence[str] = (),
    settings: BoostingSettings = BoostingSettings(),
    bins: int = 32,
) -> Ensemble:
    """Boosted trees for a 0/1 label, by histograms.

    Each level of a tree is one aggregate: gradients, hessians and rows by (node, feature, bin), added up inside the tasks; the
    driver reads at most 2^depth * features * bins sums and never a row. Splits reduce the squared error of the
    gradients p - y; a leaf is the Newton step -G / (H + penalty), taken from the sums of the split above it. The start is the
    log odds of the label. Sums are integers, so a repeated run gives the same trees. Rows without a label take no part.
    """
    known = df.where(F.col(label).isNotNull())
    binning = Binning.fit(known, numeric, indicator, bins)
    names = binning.features
    sizes = [len(c) + 1 for c in binning.cuts.values()]
    counted = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("ones")).first()
    if not counted.n or counted.ones in (0, counted.n):
        raise ValueError("boosting needs rows of both classes")
    start = math.log(counted.ones / (counted.n - counted.ones))
    # the sum over all rows stays below 2^62
    scale = float(1 << max(1, min(FRACTION_BITS, 61 - counted.n.bit_length())))
    rows = known.select(F.col(label).cast("double").alias("y"), binning.column().alias("bins"), F.lit(start).alias("margin"))
    tasks = -(-counted.n // ROWS_A_TASK)
    work = stored(rows.repartition(tasks), "boosting-rows")
    nodes: list[tuple] = []
    losses: list[float] = []
    trees: list[_Tree] = []

    def leaf(part: _Part) -> float:
        below = part.h + settings.penalty * scale
        return settings.learning_rate * (-part.g / below) if below > 0 else 0.0

    for tree in range(settings.rounds):
        splits: dict[int, Split] = {}
        parts: dict[int, _Part] = {}
        level = [1]
        for _ in range(max(settings.max_depth, 1)):
            found = _histogram(work, trees, _Tree(settings.max_depth, splits), level, sizes, scale, tasks)
            histograms: dict[int, dict[int, dict[int, _Part]]] = {}
            for (node, feature, place), part in found:
                if feature < 0:
                    loss = part.g / scale / counted.n
                else:
                    histograms.setdefault(node, {}).setdefault(feature, {})[place] = part
            if level == [1]:
                whole = histograms[1][0].values()
                parts[1] = _Part(sum(p.rows for p in whole), sum(p.g for p in whole), sum(p.h for p in whole))
                losses.append(loss)
            after = []
            for node in level if settings.max_depth else []:
                split = best_split(histograms[node], parts[node], settings.min_rows)
                if split:
                    splits[node] = split
                    parts[2 * node], parts[2 * node + 1] = split.left, split.right
                    after += [2 * node, 2 * node + 1]
            level = after
            if not level:
                break
        leaves = {n: leaf(p) for n, p in parts.items() if n not in splits}
        for n, p in sorted(parts.items()):
            if n in splits:
                s = splits[n]
                nodes.append((tree, n, names[s.feature], binning.cuts[names[s.feature]][s.bin], None, p.rows, s.gain / scale / scale))
            else:
                nodes.append((tree, n, None, None, leaves[n], p.rows, None))
        trees.append(_Tree(settings.max_depth, splits, leaves))
        if len(trees) == TREES_A_WRITE:
            work, trees = stored(_after(work, trees), "boosting-rows"), []
    last = _histogram(work, trees, _Tree(0, {}), [1], sizes, scale, tasks)
    losses.append(next(part.g for (_, feature, _), part in last if feature < 0) / scale / counted.n)
    return Ensemble(start, nodes, losses)


# --- scoring of node tables -------------------------------------------------------


def _literal_trees(nodes: DataFrame, features: Sequence[str]) -> tuple[list[list[tuple]], int]:
    """Per tree its nodes as (feature, threshold, left, right, value), the root first, and the greatest depth."""
    if nodes.count() > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes do not fit an expression")
    place = {name: i for i, name in enumerate(features)}
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes.select("tree", "node", "feature", "threshold", "value").collect():
        trees.setdefault(r.tree, {})[r.node] = r
    out, depth = [], 0
    for _, held in sorted(trees.items()):
        at = {n: i for i, n in enumerate(sorted(held))}
        depth = max(depth, max(held).bit_length() - 1)
        flat = []
        for n in sorted(held):
            r = held[n]
            leaf = r.feature is None
            flat.append((None, None, None, None, r.value) if leaf else (place[r.feature], r.threshold, at[2 * n], at[2 * n + 1], None))
        out.append(flat)
    return out, depth


def _as_literal(trees: list[list[tuple]]) -> Column:
    kinds = ("int", "double", "int", "int", "double")
    names = ("f", "t", "l", "r", "v")
    # columns of arrays, so that the literal stays compact
    columns = [[[n[i] for n in tree] for tree in trees] for i in range(len(names))]
    text = [F.from_json(F.lit(_json(c)), f"array<array<{k}>>").alias(n) for c, k, n in zip(columns, kinds, names)]
    return F.struct(*text)


def _json(values) -> str:
    return "[" + ",".join("[" + ",".join("null" if v is None else repr(v) for v in tree) + "]" for tree in values) + "]"


def margin(nodes: DataFrame, features: Sequence[str], start: float = 0.0, mean: bool = False) -> Column:
    """Sum (or mean) of the leaf values that a row reaches in all trees, as one JVM expression for batch or stream.

    The nodes become constants of the plan: their number, at most MOST_NODES, is a property of the model. A missing value goes
    left. The walk ends at a leaf, after at most as many steps as the deepest tree has.
    """
    trees, depth = _literal_trees(nodes, features)
    if not trees:
        return F.lit(float(start))
    model = _as_literal(trees)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])

    def walk(i: Column) -> Column:
        def move(at: Column, _: Column) -> Column:
            value = F.get(x, F.get(F.get(model["f"], i), at))
            left = F.coalesce(F.isnan(value) | (value <= F.get(F.get(model["t"], i), at)), F.lit(True))
            to = F.when(left, F.get(F.get(model["l"], i), at)).otherwise(F.get(F.get(model["r"], i), at))
            return F.coalesce(to, at)

        end = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), move)
        return F.get(F.get(model["v"], i), end)

    reached = F.transform(F.sequence(F.lit(0), F.lit(len(trees) - 1)), walk)
    total = F.aggregate(reached, F.lit(0.0), lambda a, v: a + v)
    return F.lit(float(start)) + (total / float(len(trees)) if mean else total)


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str], start: float = 0.0, column: str = "probability") -> DataFrame:
    """Rows plus the probability of the positive class of a boosted ensemble."""
    return df.withColumn(column, 1.0 / (1.0 + F.exp(-margin(nodes, features, start))))


def forest_nodes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Node table of a saved Spark random forest of two classes; a leaf's value is its share of the positive class.

    ``path`` is the folder of the forest's own stage. The saved rows number nodes in the order of the walk and name their children, so
    heap numbers follow level by level from the roots, each level a join.
    """
    saved = spark.read.parquet(f"{path}/data")
    data = saved.select("treeID", "nodeData.*") if "nodeData" in saved.columns else saved
    share = F.get("impurityStats", F.lit(1)) / F.aggregate("impurityStats", F.lit(0.0), lambda a, v: a + v)
    named = F.get(F.lit(list(names)), F.col("split.featureIndex"))
    is_leaf = F.col("leftChild") < 0
    flat = stored(
        data.select(
            F.col("treeID").cast("int").alias("tree"), "id", "leftChild", "rightChild",
            F.when(~is_leaf, named).alias("feature"),
            F.when(~is_leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.when(is_leaf, share).alias("value"),
            F.aggregate("impurityStats", F.lit(0.0), lambda a, v: a + v).cast("long").alias("rows"),
            F.when(~is_leaf, F.col("gain")).alias("gain"),
        ),
        "forest-nodes",
    )
    level = flat.where("id = 0").withColumn("node", F.lit(1).cast("long"))
    out = level
    while True:
        children = level.where("feature is not null").select(
            "tree", F.explode(F.array(
                F.struct(F.col("leftChild").alias("id"), (F.col("node") * 2).alias("node")),
                F.struct(F.col("rightChild").alias("id"), (F.col("node") * 2 + 1).alias("node")),
            )).alias("c"),
        ).select("tree", "c.id", "c.node")
        level = stored(flat.join(children, ["tree", "id"]), "forest-level")
        if level.isEmpty():
            return out.select("tree", "node", "feature", "threshold", "value", "rows", "gain")
        out = out.unionByName(level.select(out.columns))
