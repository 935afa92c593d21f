"""What several operators of this folder use.

Texts travel as bytes (``raw_text``), so that a Python worker sees exactly the stored
UTF-8 and a null text is the empty one. Tables that more than one plan reads are written
below ``spark.checkpoint.dir`` (``stored``): a lost executor costs only its running tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir, work_root

#: A word of white-space separated text, as a Java and as a DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_text(column: str) -> Column:
    """UTF-8 bytes of a text; null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it again, with a cut lineage."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once nothing is left to read them. What lies outside the shared folder stays."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        root = path(work_root(spark))
        root = root.getFileSystem(conf).makeQualified(root).toUri().getPath().rstrip("/") + "/"
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            held = path(folder)
            if held.toUri().getPath().startswith(root):
                held.getFileSystem(conf).delete(held, True)


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def parts_for(amount: float, per_part: float, least: int = 1) -> int:
    """Number of parts of a bounded size; grows with the data, without an upper limit."""
    return max(least, math.ceil(amount / per_part))


def remainder_of_id(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; an id that is null has remainder 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % divisor, F.lit(0))


#: Arrow hands a worker whole rows up to this many bytes at a time; Spark's own limit is 64 MB, for each task that runs.
BATCH_BYTES = "4m"
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let long texts travel in batches of BATCH_BYTES, unless the session has a limit of its own."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function for ``mapInArrow``; at the end of its task Arrow gives back what it no longer uses.

    Worker processes go on to other stages, and would keep the most that any of them used.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return wrapped


def batches_of(rows: Iterator[tuple], schema: pa.Schema, at_most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Row tuples to record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= at_most:
            yield record_batch(held, schema)
            held = []
    if held:
        yield record_batch(held, schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``nodes`` has the column ``node``, ``edges`` the columns ``a`` and ``b`` of the same
    (orderable) type. Returns (node, root), root being the smallest node of the component.
    Each step keeps the number of edges and is a grouping by node; hub nodes are handled by
    a minimum per node and a join, never by a list of neighbours.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: neighbours above a node go to the least of its neighbourhood
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: neighbours below a node, and the node, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        step = stored(small, "edges")
        discard(current)
        current = step
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h"),
            F.sum(F.xxhash64("v", "u") % 1_000_003).alias("g"),
        ).first()
        if state == before:
            break
        before = state
    return nodes.join(current.select(F.col("u").alias(node), F.col("v").alias("root")), node, "left").withColumn(
        "root", F.coalesce("root", node)
    )


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, bucket: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before, within ``by`` and in the order of ``order``.

    ``bucket`` must be a monotone function of the order: totals of whole buckets are added
    up first, so that no window partition is larger than one bucket of one group.
    """
    totals = df.groupBy(*by, bucket).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(*by, bucket, F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_ahead"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, bucket]]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    inner = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.alias("l").join(ahead.alias("r"), condition).select("l.*", "r._ahead")
    return joined.withColumn(name, F.col("_ahead") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_ahead")


def draw_bound(share: float) -> int:
    """The 64-bit number that this share of all draws by hash does not exceed."""
    return min(2**63 - 1, int(-(2**63) + min(1.0, share) * 2**64))
