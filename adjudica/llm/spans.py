"""Cut texts so that equal windows of W units meet in one shard, wherever they stand.

Every window has an anchor: of the runs of ``k`` units in it, the one with the least hash,
the leftmost of equals. It depends on the window alone, so equal windows have equal anchors,
and a window whose anchor stands at one place of the corpus only is not repeated. A
span holds consecutive windows with the same anchor; window starts belong to exactly one
span. Spans that agree in anchor and text are one row with a count from then on.

An anchor whose distinct spans exceed ``SHARD_BYTES`` (a phrase met in very many contexts) is
split: its windows get the least of runs of 2k units as their anchor, then of 4k, up to the
whole window, when equal windows are all that share one.

What is left, the distinct spans of anchors that occur more than once, goes to shards by
anchor, where an operator's kernel finds the repeated windows; each span's answer then
returns to all its places. Texts are collapsed by batch before they travel, so that
exact copies travel once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, parts_for, raw_text, record_batch, stored

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_LOW = np.uint64(0xFFFFFFFF)
SHARD_BYTES = 2_000_000


def run_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k units from every position, by doubling."""
    h, size, level = units, 1, 0
    while size * 2 <= k:
        h = h[: len(h) - size] * _ODD[level % 6] + h[size:]
        size, level = size * 2, level + 1
    if size < k:
        h = h[: len(h) - (k - size)] * _ODD[level % 6] + h[k - size :]
    h = (h ^ (h >> np.uint64(31))) * _ODD[3]
    return h ^ (h >> np.uint64(29))


def anchor_spans(units: np.ndarray, ends: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash) of the spans of several texts put together.

    ``units`` are the texts' units one after the other, ``ends`` where each text ends.
    """
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    n = len(units) - window + 1
    if n <= 0:
        return empty
    hashes = run_hashes(units, k)
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    size, width = 1, window - k + 1
    while size * 2 <= width:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    anchors = (least & _LOW).astype(np.int64)
    starts = np.arange(n)
    text_of = np.searchsorted(ends, starts, side="right")
    inside = starts + window <= ends[text_of]
    starts, anchors, text_of = starts[inside], anchors[inside], text_of[inside]
    if not len(starts):
        return empty
    new = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (text_of[1:] != text_of[:-1]))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    return text_of[new], starts[new], starts[last], hashes[anchors[new]]


def pack(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(b1, b2, packed, copies): compressed texts, equal ones of a batch once; b1 and b2 identify a text."""
    schema = pa.schema([("b1", pa.int64()), ("b2", pa.int64()), ("packed", pa.binary()), ("copies", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            seen: dict[tuple[int, int], list] = {}
            for b1, b2, value in zip(batch["b1"].to_pylist(), batch["b2"].to_pylist(), batch["text"]):
                if (b1, b2) in seen:
                    seen[b1, b2][3] += 1
                else:
                    seen[b1, b2] = [b1, b2, squeeze.compress(value.as_py()), 1]
            if seen:
                yield record_batch(list(seen.values()), schema)

    return docs.select(*identity(text), raw_text(text).alias("text")).mapInArrow(run, "b1 long, b2 long, packed binary, copies long")


def identity(text: str) -> list:
    """128 bits that identify a text: two hashes with different seeds."""
    return [F.xxhash64(raw_text(text)).alias("b1"), F.xxhash64(F.lit("second"), raw_text(text)).alias("b2")]


_SPAN_COLUMNS = "anchor long, span long, b1 long, b2 long, at long, units int, copies long"


def spans_of(packed: DataFrame, units_of: Callable, window: int, k: int, buffer: int = 400_000) -> DataFrame:
    """(anchor, span, b1, b2, at, units, copies) of all texts.

    ``units_of(text)`` returns (uint64 units, function from a unit range to its bytes). With a column
    ``parts``, (at, units, copies) of unit ranges, only the windows inside these ranges are taken.
    """
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()), ("at", pa.int64()), ("units", pa.int32()), ("copies", pa.int64())])
    ranged = "parts" in packed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def flush(held):
            units = np.concatenate([h[0] for h in held])
            ends = np.cumsum([len(h[0]) for h in held])
            begin = ends - [len(h[0]) for h in held]
            texts, first, last, anchors = anchor_spans(units, ends, window, k)
            at = first - begin[texts] + np.array([h[5] for h in held], np.int64)[texts]
            length = last - first + window
            digest = xxhash.xxh3_64_intdigest
            span = np.fromiter((digest(held[t][1](a, a + n)) for t, a, n in zip(texts.tolist(), at.tolist(), length.tolist())), np.uint64, len(texts))
            ids = [np.array([h[i] for h in held], np.int64)[texts] for i in (2, 3, 4)]
            return pa.record_batch([anchors.view(np.int64), span.view(np.int64), ids[0], ids[1], at, length.astype(np.int32), ids[2]], schema=schema)

        held, size = [], 0
        for batch in batches:
            wanted = batch["parts"].to_pylist() if ranged else [None] * batch.num_rows
            for b1, b2, copies, parts, value in zip(*(batch[c].to_pylist() for c in ("b1", "b2", "copies")), wanted, batch["packed"]):
                units, cut = units_of(unpack.decompress(value.as_py()))
                for at, n, times in [(p["at"], p["units"], p["copies"]) for p in parts] if ranged else [(0, len(units), copies)]:
                    if n >= window:
                        held.append((units[at : at + n], cut, b1, b2, times, at))
                        size += n
                    if size >= buffer:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return packed.select("b1", "b2", "copies", "packed", *["parts"] * ranged).mapInArrow(run, _SPAN_COLUMNS)


def live_places(places: DataFrame, most: float) -> DataFrame:
    """The spans of anchors that occur more than once, and whether all spans of the anchor have more than ``most`` units."""
    live = places.groupBy("anchor").agg(F.sum("copies").alias("n"), (F.sum("units") > most).alias("crowded")).where("n > 1")
    return stored(places.join(live.select("anchor", "crowded"), "anchor"), "span-live")


def split_anchors(packed: DataFrame, places: DataFrame, units_of: Callable, window: int, k: int, most: float) -> DataFrame:
    """The places, cut by ever longer runs until the distinct spans of no anchor have more than ``most`` units.

    ``places`` comes from ``live_places``. At runs of a whole window an anchor has one distinct span.
    """
    done: list[DataFrame] = []
    texts = packed.dropDuplicates(["b1", "b2"]).select("b1", "b2", "packed", "copies")
    while k < window:
        distinct = places.where("crowded").groupBy("anchor", "span").agg(F.first("units").alias("units"))
        heavy = distinct.groupBy("anchor").agg(F.sum("units").alias("total")).where(F.col("total") > most).select("anchor")
        heavy = stored(heavy, "span-heavy")
        if heavy.isEmpty():
            break
        k = min(2 * k, window)
        done.append(places.join(heavy, "anchor", "left_anti"))
        ranges = places.join(heavy, "anchor").groupBy("b1", "b2", "at", "units").agg(F.sum("copies").alias("copies"))
        parts = ranges.groupBy("b1", "b2").agg(F.collect_list(F.struct("at", "units", "copies")).alias("parts"))
        cut = stored(spans_of(texts.join(parts, ["b1", "b2"]), units_of, window, k), "span-places")
        places = live_places(cut, most)
    for held in done:
        places = places.unionByName(held)
    return places


def repeated_windows(
    docs: DataFrame, units_of: Callable, kernel: Callable, window: int, k: int, bytes_per_unit: float, key: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """The packed texts, and (b1, b2, runs): per text the runs (first, last) of repeated window starts.

    ``kernel(texts, counts)`` gets the distinct spans of a shard and how often each
    occurs; it returns for each span the list of (first, last) window starts that are repeated.
    """
    packed = stored(pack(docs, key, text), "span-texts")
    places = stored(spans_of(packed, units_of, window, k), "span-places")
    most = SHARD_BYTES / bytes_per_unit
    places = split_anchors(packed, live_places(places, most), units_of, window, k, most)
    # one place stands for all equal spans; fixed-width columns keep this a hash aggregate
    distinct = places.groupBy("anchor", "span").agg(
        F.sum("copies").alias("n"), *[F.first(c).alias(c) for c in ("b1", "b2", "at", "units")]
    )
    distinct = stored(distinct, "span-distinct")
    volume = (distinct.agg(F.sum("units")).first()[0] or 0) * bytes_per_unit
    wanted = distinct.groupBy("b1", "b2").agg(F.collect_list(F.struct("anchor", "span", "n", "at", "units")).alias("wanted"))
    cut = packed.dropDuplicates(["b1", "b2"]).join(wanted, ["b1", "b2"]).select("packed", "wanted").mapInArrow(
        _cutter(units_of), "anchor long, span long, n long, bytes binary"
    )
    shards = cut.repartition(parts_for(volume, SHARD_BYTES, 2), "anchor").mapInArrow(
        _shard(kernel), "anchor long, span long, first array<int>, last array<int>"
    )
    answers = stored(shards, "span-answers")
    back = places.join(answers, ["anchor", "span"]).groupBy("b1", "b2", "at").agg(
        F.first(F.arrays_zip("first", "last")).alias("runs")
    )
    runs = back.groupBy("b1", "b2").agg(F.sort_array(F.collect_list(F.struct("at", "runs"))).alias("runs"))
    return packed, stored(runs, "span-runs")


def _cutter(units_of: Callable) -> Callable:
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()

        def rows():
            for batch in batches:
                for value, wanted in zip(batch["packed"], batch["wanted"].to_pylist()):
                    _, cut = units_of(unpack.decompress(value.as_py()))
                    for w in wanted:
                        yield w["anchor"], w["span"], w["n"], bytes(cut(w["at"], w["at"] + w["units"]))

        yield from batches_of(rows(), schema)

    return run


def _shard(kernel: Callable) -> Callable:
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, spans, counts, texts = [], [], [], []
        for batch in batches:
            anchors += batch["anchor"].to_pylist()
            spans += batch["span"].to_pylist()
            counts += batch["n"].to_pylist()
            texts += batch["bytes"].to_pylist()
        if not texts:
            return
        found = kernel(texts, np.array(counts))
        rows = ((a, s, [x for x, _ in f], [y for _, y in f]) for a, s, f in zip(anchors, spans, found) if f)
        yield from batches_of(rows, schema)

    return run


def merged_runs(runs: list[dict], window: int) -> list[tuple[int, int]]:
    """Covered unit ranges [start, end), maximal and ascending, from the runs of one text."""
    out: list[list[int]] = []
    for span in runs:
        for r in span["runs"]:
            start, end = span["at"] + r["first"], span["at"] + r["last"] + window
            if out and start <= out[-1][1]:
                out[-1][1] = max(end, out[-1][1])
            else:
                out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, packed: DataFrame, runs: DataFrame, apply: Callable, window: int, columns: str, key: str, text: str) -> DataFrame:
    """(doc_id, *columns): ``apply(text, ranges)`` of every document, worked out once per distinct text."""
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(columns)
    both = packed.select("b1", "b2", "packed").join(runs, ["b1", "b2"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            results = [
                apply(unpack.decompress(v.as_py()), merged_runs(r or [], window)) for v, r in zip(batch["packed"], batch["runs"].to_pylist())
            ]
            cols = [pa.array(c) for c in zip(*results)] if results else []
            if results:
                yield pa.record_batch([batch["b1"], batch["b2"], *cols], names=["b1", "b2", *kind.names])

    worked = both.mapInArrow(run, f"b1 long, b2 long, {columns}").dropDuplicates(["b1", "b2"])
    ids = docs.select(F.col(key).alias("doc_id"), *identity(text))
    return ids.join(worked, ["b1", "b2"]).select("doc_id", *kind.names)
