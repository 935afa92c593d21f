"""Hard negatives by exact search in cover trees over norm-augmented vectors.

Entries become integers, floor(``scale`` * entry), and a score is an integer inner product. Vectors get one coordinate
more, which brings all of them to the largest norm; then a larger inner product is a smaller distance.

The uppermost level is a bounded number of drawn centres: every vector goes to its nearest one, whose covering radius is the
largest distance found. Below a centre, vectors lie in blocks of about ``BLOCK`` (a centre with more has several, dealt by
hash), and each block is a cover tree: the children of a node cover its vectors with half its radius, its own centre is the
first of them, and no centre lies within that radius of an earlier one. Every node keeps the radius that it really needs.

A query has windows of scores. The vectors of a node lie in a cap of the sphere of augmented vectors, around its
centre and as wide as its radius, which bounds their scores from both sides. A centre outside of all windows is not visited; within a block the descent is
best first and skips nodes whose bounds lie outside of every window, or below the k-th score already found in it. Leaves are verified with
the exact product. Each search has two rounds: the block group of the anchor's own centre gives a k-th score, which then
spares the anchor most of the others where the vectors are clustered. Isotropic vectors spare little: then an anchor meets most vectors, block by block.

Mining takes, for each anchor, the ``positives`` best rows of its label, and for each of them the ``negatives`` best rows of
other labels whose score is between ``low`` and ``high`` per cent of the positive's.

Defined results: rows without an id, label or vector, with an empty one or one that holds a null or non-finite entry, take no part; zero
vectors do (score 0); a repeated row is a row of its own, also as anchor; equal scores go to the smaller id; vectors of another dimension are
searched apart; entries and scores beyond 64 bits take the nearest 64-bit number; positives below 0 have an empty window; an empty
table, or one without anchors, gives no rows; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import batches_of, draw_bound, parts_for, stored
from .whitening import by_dimension, integer_vector, matrix_of, sound

BLOCK = 2048
LEAF = 16
#: Centres of the uppermost level, for each dimension.
CENTRES = 4096
#: Anchors that visit one copy of a block.
VISITORS = 4096
LEAST, MOST = -(2**63), 2**63 - 1


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, as longs."""
    size = max(abs(int(q.max())), abs(int(q.min()))) * max(abs(int(x.max())), abs(int(x.min()))) if len(x) else 0
    if size * len(q) < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    whole = x.astype(object) @ q.astype(object)
    return np.array([min(max(int(v), LEAST), MOST) for v in whole], np.int64)


def cap_bounds(cosine: np.ndarray, radius: np.ndarray, sphere: float, length: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of a query of a length with the vectors of caps on a sphere.

    ``cosine`` is that between query and cap centre. The slack exceeds what rounding can do.
    """
    half = np.arccos(np.clip(1.0 - radius**2 / (2.0 * sphere**2), -1.0, 1.0)) if sphere else np.zeros(len(radius))
    angle, slack = np.arccos(np.clip(cosine, -1.0, 1.0)), 1e-6 * sphere * length + 1.0
    low = sphere * length * np.cos(np.minimum(np.pi, angle + half)) - slack
    return low, sphere * length * np.cos(np.maximum(0.0, angle - half)) + slack


def augmented(x: np.ndarray, sphere: float) -> np.ndarray:
    """Vectors with the coordinate that brings them to the norm ``sphere``."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(sphere**2 - np.einsum("ij,ij->i", x, x), 0.0))[:, None]])


class CoverTree:
    """Cover tree of one block. Nodes: centre (a vector's place), radius, children, and vectors held by the node itself."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.x, self.ids, self.labels, self.rows = x, ids, labels, rows
        self.sphere = float(np.sqrt(np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64)).max()))
        points = augmented(x, self.sphere)
        self.centre, self.radius, self.children, self.held = [], [], [], []
        self._add(0, np.arange(len(x)), self._distances(points, 0, np.arange(len(x))))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, members = todo.pop()
            if len(members) <= LEAF or self.radius[node] <= 1e-9 * self.sphere:
                self.held[node] = members
                continue
            own = []
            for centre, covered, far in self._cover(points, members, self.centre[node], self.radius[node] / 2):
                if len(covered) <= LEAF:
                    own.append(covered)
                else:
                    self.children[node].append(self._add(centre, covered, far))
                    todo.append((self.children[node][-1], covered))
            self.held[node] = np.concatenate(own) if own else np.empty(0, int)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.children = [np.array(c, int) for c in self.children]

    def _add(self, centre: int, members: np.ndarray, far: np.ndarray) -> int:
        self.centre.append(centre)
        self.radius.append(float(far.max()))
        self.children.append([])
        self.held.append(None)
        return len(self.centre) - 1

    @staticmethod
    def _distances(points: np.ndarray, centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((points[members] - points[centre]) ** 2).sum(axis=1), 0.0))

    def _cover(self, points: np.ndarray, members: np.ndarray, centre: int, radius: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(centre, members, distances) of children that cover with ``radius``; the node's own centre comes first."""
        # a block's members have a bounded matrix of distances
        inner = points[members]
        square = np.einsum("ij,ij->i", inner, inner)
        distance = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2.0 * inner @ inner.T, 0.0))
        left = np.ones(len(members), bool)
        at = int(np.flatnonzero(members == centre)[0])
        while True:
            covered = left & (distance[at] <= radius)
            covered[at] = True
            yield int(members[at]), members[covered], self._distances(points, int(members[at]), members[covered])
            left &= ~covered
            if not left.any():
                return
            at = int(left.argmax())

    def search(self, q: np.ndarray, label: int, row: int, windows: list[dict], k: int, same: bool) -> Iterator[tuple]:
        """(window, id, row, score) of the k best vectors in each window, of the query's label or of other labels."""
        length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        low = np.array([w["lo"] for w in windows], np.int64)
        high = np.array([w["hi"] for w in windows], np.int64)
        least = np.array([max(w["lo"], w["floor"]) for w in windows], np.int64)
        best: list[list[tuple]] = [[] for _ in windows]

        def bounds(nodes):
            cosine = products(self.x[self.centre[nodes]], q) / (self.sphere * length or 1.0)
            return cap_bounds(cosine, self.radius[nodes], self.sphere, length)

        def open_(lower, upper):
            return ((upper >= least) & (lower <= high)).any()

        (lower,), (upper,) = bounds(np.array([0]))
        queue = [(-upper, 0, lower)]
        while queue and -queue[0][0] >= least.min():
            upper, node, lower = heapq.heappop(queue)
            if not open_(lower, -upper):
                continue
            held = self.held[node]
            fits = held[(self.labels[held] == label) == same]
            fits = fits[self.rows[fits] != row]
            if len(fits):
                scores = products(self.x[fits], q)
                for w in range(len(windows)):
                    inside = np.flatnonzero((scores >= least[w]) & (scores <= high[w]))
                    if len(inside) > 4 * k:
                        edge = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
                        inside = inside[scores[inside] >= edge]
                    if len(inside):
                        some = [(-int(scores[i]), int(self.ids[fits[i]]), int(self.rows[fits[i]])) for i in inside]
                        best[w] = heapq.nsmallest(k, best[w] + some)
                        if len(best[w]) == k:
                            least[w] = max(least[w], -best[w][-1][0])
            nodes = self.children[node]
            if len(nodes):
                for n, lo, up in zip(nodes, *bounds(nodes)):
                    if open_(lo, up):
                        heapq.heappush(queue, (-up, int(n), lo))
        for w, found in zip(windows, best):
            for score, i, r in found:
                yield w["w"], i, r, -score

    def pack(self) -> bytes:
        largest = max(abs(int(self.x.max())), abs(int(self.x.min())))
        kind = next((t for t in (np.int8, np.int16, np.int32) if largest <= np.iinfo(t).max), np.int64)
        return pickle.dumps({**self.__dict__, "x": self.x.astype(kind)})

    @classmethod
    def unpack(cls, data: bytes) -> "CoverTree":
        tree = cls.__new__(cls)
        tree.__dict__ = pickle.loads(data)
        tree.x = tree.x.astype(np.int64)
        return tree


# --- on Spark -------------------------------------------------------------------


def numbered(vectors: DataFrame, label: Column, scale: float, key: str, vector: str) -> DataFrame:
    """(row, vec_id, label, dim, x, square) of the rows that take part, stored: a row keeps its number."""
    rows = vectors.where(sound(vector)).select(
        F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), integer_vector(vector, scale).alias("x")
    )
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    rows = rows.where("vec_id is not null and label is not null").select("*", F.size("x").alias("dim"), square.alias("square"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "cover-rows")


class TopLevel:
    """Drawn centres of one dimension, and the sphere that all vectors are brought to."""

    def __init__(self, sphere: float, centres: np.ndarray):
        self.sphere, self.centres = sphere, centres
        self.lifted = augmented(centres, sphere)
        self.radius = np.zeros(len(centres))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lifted = augmented(x, self.sphere)
        near = (lifted @ self.lifted.T).argmax(axis=1)
        return near, np.sqrt(((lifted - self.lifted[near]) ** 2).sum(axis=1))

    def visited(self, q: np.ndarray, low: list[int], high: list[int]) -> np.ndarray:
        """Centres that may hold a score within one of the windows."""
        length = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        cosine = (self.centres @ q.astype(np.float64)) / (self.sphere * length or 1.0)
        lower, upper = cap_bounds(cosine, self.radius, self.sphere, length)
        low, high = np.array(low, np.float64), np.array(high, np.float64)
        return np.flatnonzero(((upper[:, None] >= low) & (lower[:, None] <= high)).any(axis=1))


def draw_centres(rows: DataFrame) -> dict[int, TopLevel]:
    """At most CENTRES centres for each dimension, about one a block, drawn by hash."""
    facts = {r.dim: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square")).collect()}
    wanted = {dim: min(CENTRES, parts_for(r.n, BLOCK)) for dim, r in facts.items()}
    # of vectors that repeat, one; twice as many as wanted in the mean, the first of which are taken
    drawn = F.xxhash64("x")
    chosen = F.lit(False)
    for dim, r in facts.items():
        chosen = chosen | ((F.col("dim") == dim) & (drawn <= draw_bound(2.0 * (wanted[dim] + 20) / r.n)))
    out = {}
    held: dict[int, list] = {}
    for r in rows.where(chosen).select("dim", "x", drawn.alias("h")).distinct().orderBy("dim", "h").collect():
        if len(held.setdefault(r.dim, [])) < wanted[r.dim]:
            held[r.dim].append(r.x)
    for dim, r in facts.items():
        # where the draw gave nothing, the origin stands for all
        out[dim] = TopLevel(float(np.sqrt(r.square)), np.array(held.get(dim) or [[0] * dim], np.float64))
    return out


class CoverForest:
    """Cover trees of all rows of a table, dealt over blocks."""

    def __init__(self, rows: DataFrame):
        self.rows, self.top = rows, draw_centres(rows)
        self.placed = stored(self._deal(), "cover-placed")
        facts = self.placed.groupBy("dim", "centre").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
        for r in facts:
            self.top[r.dim].radius[r.centre] = r.far
        # no larger than the number of centres
        parts = [(r.dim, r.centre, parts_for(r.n, BLOCK)) for r in facts]
        self.parts = rows.sparkSession.createDataFrame(parts, "dim int, centre int, parts int")
        self.trees = stored(self._build(), "cover-trees")

    def _deal(self) -> DataFrame:
        top = self.top

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, held in by_dimension(batch):
                    near, far = top[dim].nearest(matrix_of(held["x"]))
                    columns = [held[c] for c in ("row", "vec_id", "label", "dim", "x")]
                    yield pa.record_batch(
                        [*columns, pa.array(near.astype(np.int32)), pa.array(far)],
                        names=["row", "vec_id", "label", "dim", "x", "centre", "far"],
                    )

        taken = self.rows.select("row", "vec_id", "label", "dim", "x")
        return taken.mapInArrow(run, "row long, vec_id long, label long, dim int, x array<long>, centre int, far double")

    def _build(self) -> DataFrame:
        def build(group: pa.Table) -> pa.Table:
            group = group.combine_chunks().sort_by("row")
            x = group["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
            tree = CoverTree(x, *[group[c].to_numpy() for c in ("vec_id", "label", "row")])
            return pa.table({**{c: group[c].slice(0, 1) for c in ("dim", "centre", "part")}, "tree": pa.array([tree.pack()], pa.binary())})

        part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        dealt = self.placed.join(F.broadcast(self.parts), ["dim", "centre"]).withColumn("part", part).drop("parts", "far")
        return dealt.groupBy("dim", "centre", "part").applyInArrow(build, "dim int, centre int, part int, tree binary")

    def _route(self, asked: DataFrame) -> DataFrame:
        """Queries with each centre that they must visit, their own excepted."""
        top = self.top
        names = asked.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places, centres = [], []
                for i, (dim, own, x, windows) in enumerate(zip(*[batch[c].to_pylist() for c in ("dim", "centre", "x", "windows")])):
                    low, high = [max(w["lo"], w["floor"]) for w in windows], [w["hi"] for w in windows]
                    visited = top[dim].visited(np.array(x, np.int64), low, high)
                    visited = visited[visited != own]
                    places += [i] * len(visited)
                    centres += visited.tolist()
                for at in range(0, len(places), 1000):
                    some = batch.take(pa.array(places[at : at + 1000], pa.int64()))
                    columns = [pa.array(centres[at : at + 1000], pa.int32()) if c == "centre" else some[c] for c in names]
                    yield pa.record_batch(columns, names=names)

        return asked.mapInArrow(run, asked.schema)

    def _visit(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """(row, w, other, other_row, score): what each visited block has to offer."""
        copies = parts_for(asked.select("row").distinct().count(), VISITORS)
        salt = F.pmod(F.xxhash64("row"), F.lit(copies)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        queries = asked.join(F.broadcast(self.parts), ["dim", "centre"]).select(
            "dim", "centre", every, salt.alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), "row", "label", "x", "windows"
        )
        needed = asked.select("dim", "centre").distinct()
        blank = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("row", "label", "x", "windows")]
        trees = self.trees.join(needed, ["dim", "centre"], "left_semi").select(
            "dim", "centre", "part", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("salt"), F.lit(0).alias("kind"), "tree", *blank
        )
        place = ["dim", "centre", "part", "salt"]
        together = trees.unionByName(queries).repartition(*place).sortWithinPartitions(*place, "kind")
        schema = pa.schema([("row", pa.int64()), ("w", pa.int32()), ("other", pa.int64()), ("other_row", pa.int64()), ("score", pa.int64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def offers():
                tree = None  # of the place that the rows have come to
                for batch in batches:
                    kinds, packed = batch["kind"].to_pylist(), batch["tree"]
                    asked_of = zip(*[batch[c].to_pylist() for c in ("row", "label", "x", "windows")])
                    for i, (row, label, x, windows) in enumerate(asked_of):
                        if kinds[i] == 0:
                            tree = CoverTree.unpack(packed[i].as_py())
                        else:
                            for w, other, other_row, score in tree.search(np.array(x, np.int64), label, row, windows, k, same):
                                yield row, w, other, other_row, score

            yield from batches_of(offers(), schema)

        return together.mapInArrow(run, "row long, w int, other long, other_row long, score long")

    def search(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """(row, w, rank, other, score): the k best in each window of each query (row, label, dim, centre, x, windows)."""
        order = Window.partitionBy("row", "w").orderBy(F.desc("score"), "other", "other_row")

        def best(offers):
            return offers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        home = stored(best(self._visit(asked, k, same)), "cover-home")
        reached = home.groupBy("row", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        opened = asked.select("row", F.explode("windows").alias("win")).select("row", "win.*").join(reached, ["row", "w"], "left")
        floor = F.when(F.col("n") == k, F.col("least")).otherwise(F.col("floor"))
        windows = opened.groupBy("row").agg(F.collect_list(F.struct("w", "lo", "hi", floor.alias("floor"))).alias("windows"))
        again = stored(self._route(asked.drop("windows").join(windows, "row").select(asked.columns)), "cover-routes")
        away = self._visit(again, k, same)
        return best(home.drop("rank").unionByName(away)).select("row", "w", "rank", "other", "score")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``label`` is an expression over the table's columns, ``is_anchor`` one over ``vec_id``.
    """
    rows = numbered(vectors, label, scale, key, vector)
    forest = CoverForest(rows)
    anchors = stored(forest.placed.where(is_anchor).drop("far"), "cover-anchors")
    window = lambda w, lo, hi: F.struct(w.cast("int").alias("w"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"), lo.cast("long").alias("floor"))
    everything = F.array(window(F.lit(1), F.lit(LEAST), F.lit(MOST)))
    found = stored(forest.search(anchors.withColumn("windows", everything), positives, True), "cover-positives")
    found = found.select("row", F.col("rank").alias("p"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(38,0)")
    lo, hi = F.ceil(wide * low / 100), F.floor(wide * high / 100)
    sought = found.where(lo <= hi).groupBy("row").agg(F.collect_list(window(F.col("p"), lo, hi)).alias("windows"))
    mined = forest.search(stored(anchors.join(sought, "row"), "cover-asked"), negatives, False)
    named = mined.withColumnRenamed("w", "p").join(found, ["row", "p"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
