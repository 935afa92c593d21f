"""Near-duplicate classes by SimHash with multi-index hashing.

A fingerprint has 64 bits; bit b is 1 if more than half of the text's shingle hashes (repeats included) have it. The
fingerprint is cut into two segments of 32 bits, and each segment has a table of the distinct fingerprints by its value.
Of two fingerprints at most ``DISTANCE`` = 2 bits apart, either the first segments differ in at most one bit or
the second segments are equal. So a fingerprint looks up the 33 values of the Hamming ball of radius 1 around its
first segment, and the one value of its second; what a table holds there is verified on all 64 bits.

A table place that holds more than ``PLACE`` fingerprints is not joined pair by pair. It is indexed once more by the other segment:
its members are entered under every value of a small ball around theirs, so that those who share an entry are at most
two bits apart. An entry is one point of the 64-bit space, and no more than 65 distinct fingerprints lie within
one bit of a point. Each member is verified against the entry's least one, which links all of them. So work stays in proportion to the
distinct fingerprints, however many share a segment, and no link is lost.

Defined results: a null, empty or blank text has the fingerprint 0, which links like any other; a text of fewer words than a
shingle is one shingle; texts of any length are read whole, in pieces; rows of equal fingerprint are one node, so that
repeated rows and copies, however many, cost nothing more; a row without an id gets the smallest id of its component, or null
if no member has one; a bit set in exactly half of the hashes is 0; an empty table gives no rows; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, raw_text, stored

WIDTH = 3
SEED = 42
DISTANCE = 2
PLACE = 16
_LOW = 0xFFFFFFFF
_BYTES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    out = np.zeros((8, 8), np.int64)
    # eight byte-wide counters in a number hold 255 hashes
    whole = len(hashes) // 255 * 255
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _BYTES
        sums = np.concatenate([lanes[:whole].reshape(-1, 255).sum(axis=1, dtype=np.uint64), [lanes[whole:].sum(dtype=np.uint64)]])
        out[:, shift] += sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, in pieces of bounded size."""
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        yield np.array([digest(b" ".join(words), SEED)] if words else [], np.uint64)
        return
    piece = 1 << 16
    for at in range(0, len(words) - width + 1, piece):
        part = words[at : at + piece + width - 1]
        joined = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(part) - width + 1]
        runs = zip(starts.tolist(), ends[width - 1 :].tolist())
        yield np.fromiter((digest(joined[s:e], SEED) for s, e in runs), np.uint64, len(starts))


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text.lower().split(), width):
        counts += bit_counts(hashes)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t.as_py()) for t in batch["text"]), np.uint64, len(batch))
            yield pa.record_batch([batch["doc_id"], pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    read = docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text"))
    return read.mapInArrow(run, "doc_id long, bits long")


def first_segment(bits: Column) -> Column:
    return F.shiftrightunsigned(bits, 32)


def second_segment(bits: Column) -> Column:
    return bits.bitwiseAND(F.lit(_LOW))


def ball(value: Column) -> Column:
    """The 33 values at most one bit from a segment."""
    one = F.lit(1).cast("long")
    flips = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: value.bitwiseXOR(F.call_function("shiftleft", one, b)))
    return F.concat(F.array(value), flips)


def near(x: str, y: str) -> Column:
    """Verification on all bits."""
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= DISTANCE


def linked(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``bits``, enough to connect all that are at most DISTANCE apart."""
    first, second = first_segment(F.col("bits")), second_segment(F.col("bits"))
    held = nodes.select(
        "bits", F.explode(F.array(F.struct(F.lit(1).alias("segment"), first.alias("value")), F.struct(F.lit(2).alias("segment"), second.alias("value")))).alias("p")
    ).select("bits", "p.*")
    places = stored(held.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")), "simhash-places")
    # what is looked up: a ball in the first table, a point in the second
    probes = nodes.select("bits", F.lit(1).alias("segment"), F.explode(ball(first)).alias("value")).unionByName(
        nodes.select("bits", F.lit(2).alias("segment"), second.alias("value"))
    )
    # a fingerprint that only finds itself needs no second look
    own = ((F.col("segment") == 1) & (F.col("value") == first)) | (F.col("segment") == 2)
    found = stored(probes.join(places, ["segment", "value"]).where(~own | (F.col("n") > 1)), "simhash-found")
    small = held.join(places.where(F.col("n") <= PLACE), ["segment", "value"]).select("segment", "value", F.col("bits").alias("other"))
    pairs = found.where(F.col("n") <= PLACE).drop("n").alias("l").join(
        small.alias("r"),
        (F.col("l.segment") == F.col("r.segment")) & (F.col("l.value") == F.col("r.value")) & (F.col("l.bits") != F.col("r.other")) & near("l.bits", "r.other"),
    )
    direct = pairs.select(F.greatest("bits", "other").alias("a"), F.least("bits", "other").alias("b")).distinct()

    # places with many: the other segment is the second index
    many = found.where(F.col("n") > PLACE)
    at_home = F.col("value") == first
    around = F.when(F.col("segment") == 2, ball(first)).when(at_home, ball(second)).otherwise(F.array(second))
    entries = many.select("bits", "segment", "value", F.explode(around).alias("other"))
    high, low = F.when(F.col("segment") == 1, F.col("value")).otherwise(F.col("other")), F.when(F.col("segment") == 1, F.col("other")).otherwise(F.col("value"))
    entries = entries.select("bits", F.shiftleft(high, 32).bitwiseOR(low).alias("entry")).distinct()
    # at most 65 fingerprints an entry
    least = F.min("bits").over(Window.partitionBy("entry"))
    stars = entries.select("bits", least.alias("least")).where((F.col("bits") != F.col("least")) & near("bits", "least"))
    return direct.unionByName(stars.select(F.col("bits").alias("a"), F.col("least").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits, component_id) for every row of ``docs``."""
    signed = stored(fingerprints(docs, key, text), "simhash-documents")
    nodes = stored(signed.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    edges = stored(linked(nodes.select("bits")), "simhash-edges")
    rooted = components(nodes.withColumnRenamed("bits", "node"), edges)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select(F.col("node").alias("bits"), "component_id"), "simhash-components")
    return signed.join(named, "bits").select("doc_id", "bits", "component_id")


def hexadecimal(bits: Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
