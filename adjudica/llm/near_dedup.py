"""Near-duplicate classes by MinHash with tensored banding.

A table key of six minhashes is put together from two halves of three: with two collections
of ``GROUPS`` halves each, GROUPS * GROUPS tables cost 6 * GROUPS minhashes instead of
6 * GROUPS ** 2. A pair of similarity 0.75 shares a half with probability 0.42; with 18
halves a side it is missed in all 324 tables with probability 1e-4, one of 0.8 with 2e-6.

Documents with equal sets are one node from the start. Only halves that two nodes share are
put together. Members of a bucket are compared with its best connected member first, then with one
drawn per bucket. These steps pass over pairs whose one-bit sketches (a bit per minhash) differ in more
than ``MAX_DIFFERENT`` places; they lose nothing, as the last step has no such filter: the documents of buckets that still
hold several components are joined on their rare shingles (``prefix_pairs``), and pairs that meet in a table are kept. Every link is
confirmed on the full sets.

Defined results: a null or wordless text has the empty set, links with nothing and is kept;
rows of equal text are one node; a document without an id takes the smallest id of its
component, and is kept where no member has one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, components, discard, raw_text, releasing, stored

GROUPS = 18
PER_HALF = 3
#: Of the 2 * GROUPS * PER_HALF bits of a sketch; 0.75 gives 13.5 on average, with a deviation of 3.4.
MAX_DIFFERENT = 29
WIDTH = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 2**63, 2 * GROUPS * PER_HALF, np.uint64)
_MULTIPLY = _rng.integers(0, 2**63, 2 * GROUPS * PER_HALF, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; quicker than to look them up in a memory of many words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of ``width`` consecutive words, ascending; a shorter text is one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = (out * _MIX) ^ words[i : len(words) - size + 1 + i]
        out ^= out >> np.uint64(29)
    return np.unique(out * _MIX)


def minhashes(values: np.ndarray) -> np.ndarray:
    low = np.full(len(_XOR), np.uint64(2**64 - 1))
    for at in range(0, len(values), 4096):
        np.minimum(low, ((values[at : at + 4096] ^ _XOR[:, None]) * _MULTIPLY[:, None]).min(axis=1), out=low)
    return low


def halves(low: np.ndarray) -> np.ndarray:
    """2 * GROUPS numbers, each of PER_HALF minhashes."""
    mins = low.reshape(-1, PER_HALF)
    out = np.zeros(len(mins), np.uint64)
    for i in range(PER_HALF):
        out = (out ^ mins[:, i]) * _MIX
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def sketch(low: np.ndarray) -> tuple[int, int]:
    """A bit of each minhash, in two numbers: bits of a pair agree with probability (1 + similarity) / 2."""
    bits = np.zeros(128, np.uint8)
    bits[: len(low)] = (low >> np.uint64(17)) & np.uint64(1)
    first, second = np.packbits(bits).view(np.int64)
    return int(first), int(second)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, body, digest, n_shingles, halves, s1, s2): digest is that of the set, null if it is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("body", pa.string()), ("digest", pa.string()), ("n_shingles", pa.int64()), ("halves", pa.list_(pa.int64())), ("s1", pa.int64()), ("s2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc, body, value in zip(batch["doc_id"].to_pylist(), batch["body"].to_pylist(), batch["text"]):
                    s = shingles(word_hashes(value.as_py().lower().split()))
                    if len(s):
                        low = minhashes(s)
                        yield doc, body, xxhash.xxh3_128_hexdigest(s.tobytes()), len(s), halves(low), *sketch(low)
                    else:
                        yield doc, body, None, 0, None, None, None

        yield from batches_of(rows(), schema, 5000)

    read = docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text"))
    return read.select("doc_id", F.md5("text").alias("body"), "text").mapInArrow(
        releasing(run), "doc_id long, body string, digest string, n_shingles long, halves array<long>, s1 long, s2 long"
    )


def buckets(classes: DataFrame) -> DataFrame:
    """(bucket, node, n, s1, s2) of every table key, put together from halves that two nodes share."""
    half = classes.select("node", F.posexplode("halves").alias("i", "h"))
    shared = half.groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "h")
    live = half.join(shared, ["i", "h"]).groupBy("node").agg(
        F.collect_list(F.when(F.col("i") < GROUPS, F.struct("i", "h"))).alias("left"),
        F.collect_list(F.when(F.col("i") >= GROUPS, F.struct("i", "h"))).alias("right"),
    )
    pairs = live.select("node", F.explode("left").alias("l"), "right").select("node", "l", F.explode("right").alias("r"))
    keys = pairs.select(F.xxhash64("l.i", "l.h", "r.i", "r.h").alias("bucket"), "node")
    # a key of halves that are shared, but not together, leads nowhere
    full = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return keys.join(full, "bucket").join(classes.select("node", "n", "s1", "s2"), "node")


def may_link(percent: int, x: str, y: str) -> Column:
    """Whether the sizes and sketches of a pair allow the threshold."""
    fits = 100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n")
    first = F.bit_count(F.col(f"{x}.s1").bitwiseXOR(F.col(f"{y}.s1")))
    return fits & (first + F.bit_count(F.col(f"{x}.s2").bitwiseXOR(F.col(f"{y}.s2"))) <= MAX_DIFFERENT)


def confirm(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on their full sets."""
    full = (
        pairs.join(packed.select(F.col("node").alias("a"), F.col("packed").alias("text_a")), "a")
        .join(packed.select(F.col("node").alias("b"), F.col("packed").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def set_of(value):
            return shingles(word_hashes(unpack.decompress(value.as_py()).lower().split()))

        def rows():
            last, set_b = None, None
            for batch in batches:
                for a, b, ta, tb in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["text_a"], batch["text_b"]):
                    if b != last:
                        last, set_b = b, set_of(tb)
                    set_a = set_of(ta)
                    both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                    if 100 * both >= percent * (len(set_a) + len(set_b) - both):
                        yield a, b

        yield from batches_of(rows(), schema)

    return full.mapInArrow(releasing(run), "a long, b long")


def pack_texts(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, packed): the compressed text of one document of each wanted node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([squeeze.compress(v.as_py()) for v in batch["text"]], pa.binary())
            yield pa.record_batch([batch["doc_id"], batch["body"], packed], names=["doc_id", "body", "packed"])

    read = docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text")).select("doc_id", F.md5("text").alias("body"), "text")
    rows = read.mapInArrow(releasing(run), "doc_id long, body string, packed binary").alias("d")
    w = wanted.alias("w")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.body") == F.col("w.body"))
    return rows.join(w, same).select("w.node", "d.packed").dropDuplicates(["node"])


def shingle_sets(nodes: DataFrame, packed: DataFrame) -> DataFrame:
    """(node, shingle) of every member of the nodes' sets."""
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for node, value in zip(batch["node"].to_pylist(), batch["packed"]):
                s = shingles(word_hashes(unpack.decompress(value.as_py()).lower().split())).view(np.int64)
                for at in range(0, len(s), 100_000):
                    part = s[at : at + 100_000]
                    yield pa.record_batch([pa.array(np.full(len(part), node)), pa.array(part)], schema=schema)

    return packed.join(nodes.select("node"), "node", "left_semi").mapInArrow(releasing(run), "node long, shingle long")


def prefix_pairs(nodes: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes (node, root, n) of different components that can reach the threshold, by an exact prefix join.

    A set's shingles are ordered by the number of nodes that have them, rare ones first. With t the threshold, a pair that
    reaches it has its first common shingle among the first n - ceil(2 t n / (1 + t)) + 1 of the smaller set and the first n - ceil(t n) + 1 of
    the larger. Sizes, and what can follow that shingle in both sets, rule out more. A line that many documents share comes
    last in their order, so that it pairs none of them unless it is nearly all they have.
    """
    sets = stored(shingle_sets(nodes, packed), "minhash-sets")
    common = sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # shingles of one node only come first and pair nothing: their number is enough
    ordered = sets.join(common, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("list"))
    ranked = ordered.join(nodes, "node").select("node", "root", "n", (F.col("n") - F.size("list")).alias("ahead"), F.posexplode("list").alias("i", "e"))
    entry = ranked.select("node", "root", "n", (F.col("ahead") + F.col("i")).alias("at"), "e.shingle")
    longer = entry.where(100 * F.col("at") <= (100 - percent) * F.col("n"))
    shorter = entry.where((100 + percent) * F.col("at") <= (100 - percent) * F.col("n"))
    # a shingle within one component pairs nothing
    mixed = longer.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("shingle")
    longer = stored(longer.join(mixed, "shingle", "left_semi"), "minhash-prefixes")
    shorter = shorter.join(mixed, "shingle", "left_semi")
    left = F.least(F.col("s.n") - F.col("s.at"), F.col("l.n") - F.col("l.at"))
    fits = (
        (F.col("s.shingle") == F.col("l.shingle")) & (F.col("s.root") != F.col("l.root"))
        & ((F.col("s.n") < F.col("l.n")) | ((F.col("s.n") == F.col("l.n")) & (F.col("s.node") < F.col("l.node"))))
        & (100 * F.col("s.n") >= percent * F.col("l.n")) & ((100 + percent) * left >= percent * (F.col("s.n") + F.col("l.n")))
    )
    pairs = shorter.alias("s").join(longer.alias("l"), fits)
    found = pairs.select(F.greatest("s.node", "l.node").alias("a"), F.least("s.node", "l.node").alias("b")).distinct()
    out = stored(found, "minhash-pairs")
    discard(sets, longer)
    return out


def share_key(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that meet in a table: they agree in one half of each collection."""
    halves_of = lambda name: classes.select(F.col("node").alias(name), F.col("halves").alias(f"halves_{name}"))
    both = pairs.join(halves_of("a"), "a").join(halves_of("b"), "b")
    same = F.zip_with("halves_a", "halves_b", lambda x, y: x == y)
    met = F.exists(F.slice(same, 1, GROUPS), lambda x: x) & F.exists(F.slice(same, GROUPS + 1, GROUPS), lambda x: x)
    return both.where(met).select("a", "b")


def _unsettled(dealt: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows, with their roots, of the buckets that hold several components."""
    placed = dealt.join(roots, "node")
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    return placed.join(open_, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, body, n_shingles, component_id, kept) for every document."""
    signed = stored(signatures(docs, key, text), "minhash-documents")
    classes = signed.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "body")).alias("one"),
        *[F.first(c).alias(c) for c in ("halves", "s1", "s2")],
        F.first("n_shingles").alias("n"),
    )
    # numbers for nodes: given once, when the table is written
    numbered = classes.select(F.monotonically_increasing_id().alias("node"), "digest", "one.doc_id", "one.body", "halves", "s1", "s2", "n")
    classes = stored(numbered, "minhash-classes")
    dealt = stored(buckets(classes), "minhash-buckets")

    # the centre of a bucket is the node that meets most others in all its buckets
    degree = dealt.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = dealt.join(degree, "node")
    centre = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node", "n", "s1", "s2")).alias("c")).select("bucket", "c.*")
    met = dealt.alias("m").join(centre.alias("c"), (F.col("m.bucket") == F.col("c.bucket")) & (F.col("m.node") != F.col("c.node")) & may_link(percent, "m", "c"))
    stars = stored(met.select(F.greatest("m.node", "c.node").alias("a"), F.least("m.node", "c.node").alias("b")).distinct(), "minhash-stars")
    ends = dealt.select("node").distinct()
    packed = stored(pack_texts(docs, classes.join(ends, "node").select("node", "doc_id", "body"), key, text), "minhash-texts")
    links = stored(confirm(stars, packed, percent), "minhash-links")
    roots = first_roots = stored(components(ends, links), "minhash-roots")
    # a hub does not link everything it meets: compare with a centre drawn in each of a third of the
    # buckets that still hold several components, so that large groups grow together
    placed = first_open = stored(_unsettled(dealt, roots), "minhash-open")
    draw = F.struct(F.xxhash64("bucket", "node").alias("h"), "node", "root", "n", "s1", "s2")
    drawn = placed.where(F.pmod(F.col("bucket"), F.lit(3)) == 0).groupBy("bucket").agg(F.max(draw).alias("c")).select("bucket", "c.*")
    apart = (F.col("m.bucket") == F.col("c.bucket")) & (F.col("m.root") != F.col("c.root")) & may_link(percent, "m", "c")
    second = placed.alias("m").join(drawn.alias("c"), apart).select(F.greatest("m.node", "c.node").alias("a"), F.least("m.node", "c.node").alias("b"))
    second = stored(second.distinct().join(stars, ["a", "b"], "left_anti"), "minhash-second")
    links = links.unionByName(stored(confirm(second, packed, percent), "minhash-links"))
    roots = second_roots = stored(components(ends, links), "minhash-roots")
    # what is left, exactly: documents of buckets that still hold several components, by their rare shingles
    placed = _unsettled(dealt, roots)
    open_ = stored(placed.groupBy("node").agg(F.first("root").alias("root"), F.first("n").alias("n")), "minhash-open")
    pairs = prefix_pairs(open_, packed, percent)
    cross = share_key(pairs, classes).join(stars.unionByName(second), ["a", "b"], "left_anti")
    more = stored(confirm(cross, packed, percent), "minhash-more")
    if not more.isEmpty():
        roots = stored(components(ends, links.unionByName(more)), "minhash-roots")
        discard(first_roots, second_roots)
    else:
        discard(first_roots)
    # the result reads documents, classes and roots alone
    discard(dealt, stars, packed, links, first_open, open_, pairs, second, more)
    rooted = classes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    named = signed.join(rooted, "digest", "left")
    smallest = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = named.join(smallest, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "body", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one_of_each(docs: DataFrame, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each near-duplicate class; of rows that repeat an id and text, one."""
    kept = near_duplicates(docs, percent, key, text).where("kept").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct()
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc, body = f"c{names.index(key)}", F.md5(raw_text(f"c{names.index(text)}"))
    same = F.col(doc).cast("long").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_body"))
    chosen = rows.withColumn("_digest", body).join(kept, same, "left_semi").dropDuplicates([doc, "_digest"])
    return chosen.drop("_digest").toDF(*names)
