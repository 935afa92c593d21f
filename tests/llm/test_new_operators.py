"""SimHash classes, hard negatives and whitening against brute force, on odd rows and on empty tables."""

from __future__ import annotations

import math
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adjudica.llm import cover_tree, queries, simhash, whitening
from conftest import DATA

VECTORS = "vec_id long, embedding array<float>, label int, row string, dim string, x string, centre string, n string, bits string"
CLASH = ("clash",) * 6


# --- SimHash --------------------------------------------------------------------


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points, near):
    """Least member of each point's component."""
    parent = {p: p for p in points}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(points):
        for q in points[:i]:
            if near(p, q):
                a, b = root(p), root(q)
                parent[max(a, b)] = min(a, b)
    return {p: root(p) for p in points}


def within_two(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1") <= 2


def test_simhash_of_the_documents_equals_brute_force(spark):
    docs = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    roots = classes(sorted(set(docs.values())), within_two)
    least = {}
    for i, f in docs.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op11_simhash_dedup(spark, DATA).collect()}
    assert found == {i: (format(f, "016x"), least[roots[f]]) for i, f in docs.items()}


def test_simhash_on_odd_rows(spark):
    long = " ".join(f"w{i % 977} {i % 31}" for i in range(70_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, "One TWO three"), (5, "one  two\nthree"), (6, "one two"), (6, "one two"),
        (None, "one two"), (8, long), (9, long.upper()), (10, "é É"), (None, "nobody else writes this"), (12, "a\x00b \x1f c d"),
    ]
    docs = spark.createDataFrame([(i, t, "x", "y", "z", "u") for i, t in rows], "doc_id long, text string, bits string, node string, root string, least string")
    found = sorted((str(r.doc_id), r.bits % 2**64, r.component_id) for r in simhash.near_duplicates(docs.repartition(3)).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    roots = classes(sorted({f for _, f in prints}), within_two)

    def component(f):
        return min((i for i, g in prints if i is not None and roots[g] == roots[f]), default=None)

    assert found == sorted((str(i), f, component(f)) for i, f in prints)
    assert {i: c for i, _, c in found if i in ("1", "2", "3")} == {"1": 1, "2": 1, "3": 1}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_bits_are_counted_over_more_than_a_lane_holds():
    hashes = np.random.default_rng(3).integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert list(simhash.bit_counts(hashes)) == [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    assert simhash.bit_counts(hashes)[0] == 3000


def test_places_with_many_fingerprints_lose_no_link(spark):
    """Hundreds of fingerprints share a segment, first or second; pairs of all splits of two bits occur."""
    rng = np.random.default_rng(1)
    points = set()
    for base in rng.integers(0, 2**63, 4).tolist():
        for _ in range(150):
            flips = rng.choice(12, rng.integers(0, 5), replace=False)
            points.add(base ^ sum(1 << int(b) for b in flips))
            points.add(base ^ sum(1 << (32 + int(b)) for b in flips))
            points.add(base ^ (1 << int(rng.integers(0, 32))) ^ (1 << (32 + int(rng.integers(0, 31)))))
    points = sorted(points)
    held = {}
    for p in points:
        held[p >> 32] = held.get(p >> 32, 0) + 1
    assert max(held.values()) > simhash.PLACE
    edges = [(r.a, r.b) for r in simhash.linked(spark.createDataFrame([(p,) for p in points], "bits long")).collect()]
    assert all(within_two(a, b) for a, b in edges)
    there = set(edges) | {(b, a) for a, b in edges}
    assert classes(points, lambda a, b: (a, b) in there) == classes(points, within_two)


# --- hard negatives ---------------------------------------------------------------


def vectors_of(seed, n, dim=12, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    return (centres[rng.integers(0, 6, n)] * 0.5 + spread * 0.2 * rng.standard_normal((n, dim))).astype(np.float32)


def vector_rows():
    rows = [(i, [float(c) for c in v], int(i % 4)) for i, v in enumerate(vectors_of(5, 400))]
    rows += [(i, [float(c) for c in v], int(i % 3)) for i, v in enumerate(vectors_of(6, 60, 5), 1000)]  # another dimension
    rows += [rows[20], rows[100], rows[100], (100, rows[7][1], 2)]  # repeated rows, also of an anchor, and a repeated id
    rows += [(500 + i, rows[50][1], i % 2) for i in range(30)]  # one vector many times: ties
    rows += [(600, None, 1), (601, [], 1), (602, [0.1] * 11 + [None], 1), (603, [0.1] * 11 + [float("nan")], 1),
             (604, [float("inf")] * 12, 1), (605, rows[3][1], None), (None, rows[4][1], 1), (650, [0.0] * 12, 1)]
    return [r + CLASH for r in rows]


def plain_negatives(rows, anchors, positives=5, negatives=3):
    held = [
        (i, [math.floor(256 * float(c)) for c in v], label)
        for i, v, label, *_ in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for a, (anchor, q, label) in enumerate(held):
        if anchor % anchors:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v)), i, r) for r, (i, v, _) in enumerate(held) if r != a and len(v) == len(q)
        )
        best = [(-s, i, r) for s, i, r in scored if held[r][2] == label][:positives]
        for score, positive, _ in best:
            inside = [(-s, i) for s, i, r in scored if held[r][2] != label and 50 * score <= -100 * s <= 95 * score]
            out += [(anchor, positive, k, i, score, s) for k, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [64, 2048])
def test_hard_negatives_on_odd_rows_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = cover_tree.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, 10)
    assert len(want) > 300 and sorted(tuple(r) for r in found.collect()) == want


def test_hard_negatives_of_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert cover_tree.hard_negatives(empty, F.col("vec_id") % 10 == 0, F.col("label")).collect() == []
    few = spark.createDataFrame([(1, [0.5, 0.5], 0) + CLASH], VECTORS)
    assert cover_tree.hard_negatives(few, F.lit(False), F.col("label")).collect() == []
    assert cover_tree.hard_negatives(few, F.lit(True), F.col("label")).collect() == []


def test_cover_tree_holds_every_vector_within_its_radii():
    x = np.floor(256 * vectors_of(8, 900)).astype(np.int64)
    x[100:400] = x[100]
    tree = cover_tree.CoverTree(x, np.arange(900), np.zeros(900, int), np.arange(900))
    points = cover_tree.augmented(x, tree.sphere)

    def below(node):
        held = [tree.held[node], *[below(c) for c in tree.children[node]]]
        members = np.concatenate(held)
        far = np.sqrt(((points[members] - points[tree.centre[node]]) ** 2).sum(axis=1)).max()
        assert far <= tree.radius[node] + 1e-6
        for c in tree.children[node]:
            assert tree.radius[c] <= tree.radius[node] / 2 + 1e-6
        return members

    assert sorted(below(0)) == list(range(900))


def test_clustered_vectors_spare_nodes(monkeypatch):
    """A window above the scores of other clusters is searched without verifying them."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    x = np.floor(256 * (np.repeat(centres, 100, axis=0) + 0.02 * rng.standard_normal((2000, 16)))).astype(np.int64)
    tree = cover_tree.CoverTree(x, np.arange(2000), np.zeros(2000, int), np.arange(2000))
    seen = []
    exact = cover_tree.products
    monkeypatch.setattr(cover_tree, "products", lambda a, q: seen.append(len(a)) or exact(a, q))
    windows = [{"w": 1, "lo": cover_tree.LEAST, "hi": cover_tree.MOST, "floor": cover_tree.LEAST}]
    found = list(tree.search(x[5], 0, 5, windows, 5, True))
    order = sorted((-int(v @ x[5]), i) for i, v in enumerate(x) if i != 5)
    assert [(f[3], f[1]) for f in found] == [(-s, i) for s, i in order[:5]]
    assert sum(seen) < 500


def test_products_beyond_doubles_are_exact():
    x = np.array([[2**40 + 1, 3], [-(2**62), 2**62]], np.int64)
    q = np.array([2**20 + 1, -7], np.int64)
    assert list(cover_tree.products(x, q)) == [(2**40 + 1) * (2**20 + 1) - 21, -(2**63)]


# --- whitening ----------------------------------------------------------------------


def plain_whitening(rows, dim):
    held = [(i, [math.floor(256 * float(c)) for c in v]) for i, v, *_ in rows if v and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in held}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    scatter = n * (fit.T @ fit) - np.outer(sums, sums)
    values, vectors = np.linalg.eigh((scatter / n**2).astype(np.float64))
    return held, n, sums, scatter, values[::-1], vectors[:, ::-1]


def check_whitening(df, rows, dims):
    found = {}
    for r in df.collect():
        found.setdefault((str(r.vec_id), int(r.deviation)), []).append(r)
    total = 0
    for dim in dims:
        held, n, sums, scatter, values, vectors = plain_whitening(rows, dim)
        for i, x in held:
            centred = n * np.array(x, dtype=object) - sums
            got = found[str(i), int((centred**2).sum())]
            copies = len(got) // min(4, dim)
            assert len(got) == copies * min(4, dim)
            total += len(got) / copies
            for r in got:
                c = r.component - 1
                white = float((centred / n).astype(np.float64) @ vectors[:, c] / math.sqrt(values[c]))
                assert abs(abs(r.whitened) - abs(white)) < 1e-9 * max(1.0, abs(white))
                assert r.n == n and abs(r.explained / (values[c] / values.sum()) - 1) < 1e-10 and r.identity_error < 1e-9
    assert total == sum(len(v) for v in found.values())


def test_whitening_on_odd_rows(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    check_whitening(whitening.whiten(df), [r for r in rows if r[1]], [5, 12])
    assert whitening.whiten(df.limit(0)).collect() == []
    # equal vectors have no component
    assert whitening.whiten(df.where("vec_id between 500 and 529")).collect() == []


def test_whitening_of_the_embeddings(spark):
    df = queries.op13_whitening(spark, DATA)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert dict(df.dtypes)["deviation"] == "bigint" and df.count() == 4 * len(rows)
    check_whitening(df, rows, [64])


def test_symmetric_functions_are_exact(spark):
    """Against the polynomial by Faddeev and Le Verrier's recursion in integers."""
    rng = np.random.default_rng(4)
    x = rng.integers(-(2**40), 2**40, (9, 7)).astype(object)
    m = x.T @ x
    want, a = [1], np.zeros((7, 7), object)
    for k in range(1, 8):
        a = m @ a + want[-1] * m if k > 1 else m.copy()
        want.append(-sum(a.diagonal()) // k)
    found = whitening.symmetric_functions(spark, m)
    assert found == [(-1) ** k * c for k, c in enumerate(want)]
    roots = whitening.RealRoots(found)
    values = np.linalg.eigvalsh(m.astype(np.float64))[::-1]
    for j in range(1, 8):
        high, shift = roots.largest(j)
        assert abs(float(Fraction(high, 1 << shift)) / values[j - 1] - 1) < 1e-9


def test_a_pivot_of_zero_and_multiple_roots(spark):
    m = np.zeros((6, 6), object)
    for i, v in enumerate((9, 9, 9, 4, 4, 0)):
        m[i, i] = v
    found = whitening.symmetric_functions(spark, m)
    assert found[1] == 35 and found[6] == 0
    roots = whitening.RealRoots(found)
    assert roots.positive == 5
    tops = [roots.largest(j) for j in range(1, 6)]
    assert tops[0] == tops[1] == tops[2] and tops[3] == tops[4] != tops[0]
    vectors = whitening.null_vectors(m, tops[0], 3)
    assert np.abs(vectors.T @ vectors - np.eye(3)).max() < 1e-15 and np.abs(vectors[3:]).max() < 1e-25
    # a swap of rows is needed where the entry below the diagonal is 0
    s = np.array([[2, 0, 1], [0, 3, 1], [1, 1, 5]], object)
    a, b, c = (int(v) for v in whitening.symmetric_functions(spark, s)[1:])
    assert (a, b, c) == (10, 2 * 3 + 2 * 5 + 3 * 5 - 1 - 1, 25)


def test_close_eigenvalues_keep_their_vectors_apart():
    """Eigenvalues that differ in the 14th digit, which doubles would mix."""
    m = np.zeros((4, 4), object)
    for i, v in enumerate((10**14 + 1, 10**14, 7, 3)):
        m[i, i] = v
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], object)
    m = q @ m @ q.T  # eigenvalues 4 times as large, components q / 2
    values = [4 * (10**14 + 1), 4 * 10**14, 28, 12]
    e = [sum(math.prod(c) for c in combinations(values, k)) for k in range(5)]
    roots = whitening.RealRoots(e)
    for j in (1, 2):
        root = roots.largest(j)
        v = whitening.null_vectors(m, root, 1)[:, 0]
        assert np.abs(np.abs(v) - 0.5).max() < 1e-15 and abs(float(v @ q[:, j - 1].astype(float))) > 1.999999


def test_large_entries_are_summed_exactly(spark):
    rows = [(i, [float(2**k * (i % 5 - 2) + i) for k in (3, 30, 44)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], dtype=object)
    fit = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    held = df.select(whitening.integer_vector("embedding", 256.0).alias("x"), F.lit(3).alias("dim")).distinct()
    got_n, got_s, got_m = whitening.scatter_of(held)[3]
    assert got_n == n and got_s == list(s) and (got_m == n * (fit.T @ fit) - np.outer(s, s)).all()
    wide = {r.vec_id: r.deviation for r in whitening.whiten(df).where("component = 1").collect()}
    for i, v in enumerate(x):
        exact = int(((n * v - s) ** 2).sum())
        assert wide[i] == exact if exact < 10**38 else wide[i] is None
