"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

Passages are windows of 2 * stride words, half overlapping. The stride of an item is STRIDE,
doubled until it holds the item, so an item that was copied lies whole in one passage; items
of the same stride are searched together, and no item depends on the length of another. A posting's weight is its BM25
impact divided by the item's score for its own text: an item scores 1 against itself, and one
threshold serves all items. Retrieval is exact block-max WAND: lists sorted by item, skipped
by the sum of list maxima, then of block maxima, and everything at or above the threshold is
returned. Before that, a passage is passed over if the *leading* words it holds, an item's rarest in the
corpus, leave every item below the threshold even with all its other words. Retrieved items are verified: the share of the question's and of the
answer's word 3-grams that the passage holds; a question or an answer of one or two words
is one gram of that length. An item's answer follows its last question mark; without one its
second half counts as the answer.

The index holds a slice of at most ``SLICE_BYTES`` of item text; more items mean more slices,
one after the other, with weights from all items.

Defined results: null or wordless items match nothing; items of equal text match alike, also
under the same id; a null or wordless text has no passage; repeated rows give repeated matches.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, parts_for, raw_text, releasing

THRESHOLD = 0.5
OVERLAP = 0.5
K1, B = 1.2, 0.75
GRAM = 3
STRIDE = 64
POSTING_BLOCK = 32
SLICE_BYTES = 4_000_000
_GAPS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.lower().translate(_GAPS).split()


def grams(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def part_grams(words: list[bytes]) -> tuple[int, set[tuple[bytes, ...]]]:
    """The gram length of a question or an answer, at most GRAM, and its grams."""
    n = min(GRAM, len(words))
    return n, grams(words, n)


def question_and_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    head, mark, tail = text.rpartition(b"?")
    if mark and words_of(head) and words_of(tail):
        return words_of(head), words_of(tail)
    words = words_of(text)
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


class Postings:
    """Items that hold a word, ascending, with their weights and the largest weight of each block."""

    def __init__(self, items: list[int], weights: list[float]):
        self.items, self.weights = items, weights
        self.most = max(weights)
        self.blocks = [max(weights[i : i + POSTING_BLOCK]) for i in range(0, len(weights), POSTING_BLOCK)]


class BlockMaxIndex:
    def __init__(self, items: list[tuple[int | None, bytes]], df: dict[bytes, int], n: int, mean: float, corpus: dict[bytes, int], threshold: float):
        self.threshold, self.items, lists = threshold - 1e-9, [], defaultdict(lambda: ([], []))
        #: rare words -> (item, weight); and what an item's leading words must add up to
        self.leading: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        self.needed: list[float] = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            question, answer = question_and_answer(text)
            counts, impact = Counter(words), {}
            for w, tf in counts.items():
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                impact[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            own = sum(impact.values())
            number = len(self.items)
            self.items.append((item_id, part_grams(question), part_grams(answer)))
            rest = 1.0
            for w in sorted(impact, key=lambda w: (corpus.get(w, 0), w)):
                lists[w][0].append(number)
                lists[w][1].append(impact[w] / own)
                if rest >= self.threshold / 3:
                    self.leading[w].append((number, impact[w] / own))
                    rest -= impact[w] / own
            self.needed.append(self.threshold - max(rest, 0.0))
        self.lists = {w: Postings(*pair) for w, pair in lists.items()}

    def may_hold(self, words: set[bytes]) -> bool:
        """Whether the leading words of some item weigh enough here for it to reach the threshold."""
        sums: dict[int, float] = defaultdict(float)
        for w in self.leading.keys() & words:
            for item, weight in self.leading[w]:
                sums[item] += weight
        return any(total >= self.needed[item] - 1e-9 for item, total in sums.items())

    def search(self, words: set[bytes]) -> list[tuple[int, float]]:
        """(item, score) of every item at or above the threshold."""
        # a cursor: [current item, position, postings]
        cursors = [[p.items[0], 0, p] for w in words if (p := self.lists.get(w))]
        out, floor = [], self.threshold

        def advance(cursor, item) -> bool:
            at = bisect_left(cursor[2].items, item, cursor[1])
            if at == len(cursor[2].items):
                return False
            cursor[0], cursor[1] = cursor[2].items[at], at
            return True

        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2].most
                if bound >= floor:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            head, tail = cursors[: pivot + 1], cursors[pivot + 1 :]
            bound, end = 0.0, None
            for c in head:
                at = bisect_left(c[2].items, item, c[1])
                if at < len(c[2].items):
                    block = at // POSTING_BLOCK
                    bound += c[2].blocks[block]
                    last = c[2].items[min(len(c[2].items), (block + 1) * POSTING_BLOCK) - 1]
                    end = last if end is None else min(end, last)
            if bound < floor:  # no item up to the end of these blocks can pass
                target = end + 1
                if tail:
                    target = min(target, tail[0][0])
                target = max(target, item + 1) if not tail or tail[0][0] > item else target
                cursors = [c for c in head if advance(c, target)] + tail
            elif head[0][0] == item:
                score = sum(c[2].weights[c[1]] for c in head)
                if score >= floor:
                    out.append((item, min(1.0, score)))
                cursors = [c for c in head if advance(c, item + 1)] + tail
            else:
                cursors = [c for c in head if advance(c, item)] + tail
        return out


def _vocabulary_counts(docs: DataFrame, vocabulary: frozenset[bytes], text: str) -> dict[bytes, int]:
    """How many texts of the corpus hold each word of the index."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch["text"]:
                counts.update(vocabulary.intersection(words_of(value.as_py())))
        yield from batches_of(iter(counts.items()), schema)

    found = docs.select(raw_text(text).alias("text")).mapInArrow(releasing(run), "word binary, n long")
    return {bytes(r.word): r.n for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def stride_of(words: int) -> int:
    """The stride for an item of so many words."""
    stride = STRIDE
    while stride < words:
        stride *= 2
    return stride


def indexes(docs: DataFrame, benchmark: DataFrame, threshold: float, text: str, item_key: str, item_text: str) -> Iterator[list[tuple[BlockMaxIndex, int]]]:
    """For each slice of the items an index per stride, with the stride."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), raw_text(item_text).alias("text")).where(F.octet_length("text") > 0)
    slices = parts_for(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0, SLICE_BYTES)
    sliced = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))
    schema = pa.schema([("word", pa.binary()), ("df", pa.int64()), ("size", pa.int64())])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for value in batch["text"]:
                    held = words_of(value.as_py())
                    if held:
                        yield None, 1, len(held)
                        for w in set(held):
                            yield w, 1, 0

        yield from batches_of(rows(), schema)

    facts = items.select("text").mapInArrow(words, "word binary, df long, size long")
    facts = facts.groupBy("word").agg(F.sum("df").alias("df"), F.sum("size").alias("size")).collect()
    whole = next((r for r in facts if r.word is None), None)
    if whole is None:
        return
    df = {bytes(r.word): r.df for r in facts if r.word is not None}
    for k in range(slices):
        held = [(r.item_id, bytes(r.text)) for r in sliced.where(F.col("slice") == k).collect()]
        held.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        vocabulary = frozenset(w for _, t in held for w in words_of(t))
        corpus = _vocabulary_counts(docs, vocabulary, text)
        by_stride: dict[int, list] = defaultdict(list)
        for item in held:
            by_stride[stride_of(len(words_of(item[1])))].append(item)
        yield [(BlockMaxIndex(some, df, whole.df, whole.size / whole.df, corpus, threshold), stride) for stride, some in sorted(by_stride.items())]


def matches_in(words: list[bytes], index: BlockMaxIndex, stride: int, overlap: float) -> dict[int, tuple]:
    """item number: (passages, best score, best question overlap, best answer overlap) of verified items."""
    if index.leading.keys().isdisjoint(words):
        return {}
    starts = {k // stride for k, w in enumerate(words) if w in index.leading}
    out: dict[int, tuple] = {}
    for p in sorted({q for s in starts for q in (s - 1, s) if q >= 0}):
        passage = words[p * stride : (p + 2) * stride]
        held, distinct = {}, set(passage)
        if not index.may_hold(distinct):
            continue
        for item, score in index.search(distinct):
            _, *parts = index.items[item]
            for n, _ in parts:
                if n not in held:
                    held[n] = grams(passage, n)
            q, a = (len(part & held[n]) / len(part) if part else 1.0 for n, part in parts)
            if q >= overlap and a >= overlap:
                n, s, bq, ba = out.get(item, (0, 0.0, 0.0, 0.0))
                out[item] = (n + 1, max(s, score), max(bq, q), max(ba, a))
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, passages, score, question_overlap, answer_overlap) of every verified match."""
    columns = "doc_id long, item_id long, passages long, score double, question_overlap double, answer_overlap double"
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("passages", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text"))
    out = None
    for classes in indexes(docs, benchmark, threshold, text, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], classes=classes) -> Iterator[pa.RecordBatch]:
            def found():
                for batch in batches:
                    for doc, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                        words = words_of(value.as_py())
                        for index, stride in classes:
                            for item, facts in sorted(matches_in(words, index, stride, overlap).items()):
                                yield doc, index.items[item][0], *facts

            yield from batches_of(found(), schema)

        part = rows.mapInArrow(releasing(run), columns)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], columns)


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP,
    text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents, with all their columns, in which no item is found."""
    names = docs.columns
    kept = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{names.index(text)}"
    for classes in indexes(docs, benchmark, threshold, text, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], classes=classes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = (words_of(v.as_py()) for v in batch["_bytes"])
                clean = [not any(matches_in(words, index, stride, overlap) for index, stride in classes) for words in texts]
                yield batch.filter(pa.array(clean, pa.bool_())).drop_columns(["_bytes"])

        kept = kept.withColumn("_bytes", raw_text(body)).mapInArrow(releasing(run), kept.schema)
    return kept.toDF(*names)
