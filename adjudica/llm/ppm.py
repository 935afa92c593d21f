"""Language-model scoring by prediction by partial matching over bytes.

The trie holds, for every context of 0 to ``order`` bytes seen in training, the counts of
the bytes that followed. A byte is coded in the longest known context; if it never followed
there, an escape (method C: distinct followers over total plus distinct) leads to the next
shorter context, in which the bytes already ruled out are excluded; below the empty context
stands the uniform law over the bytes left. Byte 0xFF, which UTF-8 never uses, frames a text
on the left as context and ends it on the right, so the end is coded as well.

A pretrained score needs only one number per (order + 1)-gram. The trie is a table: counts of
the longest grams, their shorter suffixes, and the contexts. Texts are dealt into blocks
of bounded size; each block asks for the grams it holds, the answers are joined in Spark and
meet the block's texts again. So neither the trie nor the vocabulary has to fit anywhere.

Defined results: a null text is the empty text (one symbol, the end); repeated rows score
alike; without training texts every byte has probability 1/256; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, parts_for, raw_text, stored, text_bytes

ORDER = 4
FRAME = 0xFF
BLOCK_BYTES = 16_000_000
SLICE_BYTES = 2_000_000
#: The end of a text among its words; no word is empty.
END_WORD = b""


class Trie:
    """The same model for one process: adaptive scoring of single documents, and a check."""

    def __init__(self, order: int = ORDER):
        self.order, self.followers = order, {}

    def log10(self, context: bytes, symbol: int) -> float:
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = self.followers.get(context[len(context) - j :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / total)
            out += math.log10(len(left) / total)
            excluded |= set(left)
        return out - math.log10(256 - len(excluded))

    def learn(self, context: bytes, symbol: int) -> None:
        for j in range(self.order + 1):
            node = self.followers.setdefault(context[len(context) - j :], Counter())
            node[symbol] += 1

    def walk(self, text: bytes, learn: bool) -> float:
        framed, total = bytes([FRAME]) * self.order + text + bytes([FRAME]), 0.0
        for i in range(self.order, len(framed)):
            context = framed[i - self.order : i]
            total += self.log10(context, framed[i])
            if learn:
                self.learn(context, framed[i])
        return total


def segments(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, gram code) of every symbol, in slices of bounded size."""
    pad, end = bytes([FRAME]) * order, bytes([FRAME])
    held, owners, size = [], [], 0
    for k, text in enumerate(texts):
        framed = pad + text + end
        for at in range(order, len(framed), SLICE_BYTES):
            piece = framed[at - order : at + SLICE_BYTES]
            held.append(piece)
            owners.append(k)
            size += len(piece)
            if size >= SLICE_BYTES:
                yield _codes(held, owners, order)
                held, owners, size = [], [], 0
    if held:
        yield _codes(held, owners, order)


def _codes(pieces: list[bytes], owners: list[int], order: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths) - lengths
    n = len(data) - order
    code = data[order:].astype(np.int64)
    for i in range(1, order + 1):
        code |= data[order - i : order - i + n].astype(np.int64) << (8 * i)
    # the first bytes of a piece are context only
    wanted = np.ones(len(data), bool)
    wanted[(starts[:, None] + np.arange(order)).ravel()] = False
    return np.repeat(np.array(owners), lengths - order), code[wanted[order:]]


def _blocks(docs: DataFrame, training: Column, key: str, text: str) -> tuple[DataFrame, int]:
    count = parts_for(text_bytes(docs, text), BLOCK_BYTES, 2)
    rows = docs.select(F.col(key).alias("doc_id"), raw_text(text).alias("text"), training.alias("training"))
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int")), count


def block_facts(blocks: DataFrame, count: int, order: int) -> DataFrame:
    """(block, gram, word, n): the grams and the words of each block with their training counts (0: only asked for)."""
    schema = pa.schema([("block", pa.int32()), ("gram", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def batch(block, grams, words, counts):
        n = len(counts)
        none = pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())
        return pa.record_batch(
            [pa.array(np.full(n, block, np.int32)), none[0] if grams is None else pa.array(grams), none[1] if words is None else pa.array(words, pa.binary()), pa.array(counts, pa.int64())],
            schema=schema,
        )

    def merged(parts):
        grams, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        by = np.argsort(grams, kind="stable")
        grams, counts = grams[by], counts[by]
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        return grams[first], np.add.reduceat(counts, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, bool], list[bytes]] = {}
        size: Counter = Counter()
        words: dict[int, Counter] = {}
        parts: dict[int, list] = {}

        def count_grams(block, training):
            for _, code in segments(waiting.pop((block, training)), order):
                grams, n = np.unique(code, return_counts=True)
                parts.setdefault(block, []).append((grams, n if training else np.zeros_like(n)))
            if len(parts[block]) > 16:
                parts[block] = [merged(parts[block])]

        def flush(block):
            for training in (True, False):
                if (block, training) in waiting:
                    count_grams(block, training)
            grams, n = merged(parts.pop(block))
            for at in range(0, len(grams), 200_000):
                yield batch(block, grams[at : at + 200_000], None, n[at : at + 200_000])
            counted = list(words.pop(block).items())
            for at in range(0, len(counted), 50_000):
                piece = counted[at : at + 50_000]
                yield batch(block, None, [w for w, _ in piece], [n for _, n in piece])

        for rows in batches:
            for block, training, value in zip(rows["block"].to_pylist(), rows["training"].to_pylist(), rows["text"]):
                text = value.as_py()
                waiting.setdefault((block, training), []).append(text)
                counter = words.setdefault(block, Counter())
                tokens = [*text.lower().split(), END_WORD]
                if training:
                    counter.update(tokens)
                else:
                    counter.update(dict.fromkeys(tokens, 0))
                size[block] += len(text)
                if sum(map(len, waiting[block, training][-64:])) > SLICE_BYTES or len(waiting[block, training]) > 1000:
                    count_grams(block, training)
                if size[block] > 2 * BLOCK_BYTES:
                    yield from flush(block)
                    del size[block]
        for block in list(words):
            yield from flush(block)

    return blocks.repartition(count, "block").select("block", "training", "text").mapInArrow(
        run, "block int, gram long, word binary, n long"
    )


def _key(kind: int, order, code):
    """One number for (kind, order, code): codes have at most 48 bits."""
    tag = (F.lit(kind * 16) + order).cast("long")
    return F.shiftleft(tag, 48).bitwiseOR(code.cast("long"))


def gram_scores(asked: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """(gram, value): log10 probability of the last byte of every gram asked for.

    ``counts`` has (gram, c) of the training texts. Suffixes of the grams give the counts of
    all shorter contexts. A gram that was seen is a division; the others look up
    their contexts of every order in one join.
    """
    masks = [(1 << (8 * (j + 1))) - 1 for j in range(order + 1)]
    levels = counts.select(
        F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("gram").bitwiseAND(F.lit(m)).alias("g")) for j, m in enumerate(masks)])).alias("x"), "c"
    ).groupBy("x.j", "x.g").agg(F.sum("c").alias("c"))
    levels = stored(levels, "ppm-counts")
    lower_mask = F.element_at(F.array(*[F.lit(m) for m in [0, *masks[:-1]]]), F.col("j") + 1)
    upper = levels.select("j", "g", "c", lower_mask.bitwiseAND(F.col("g")).alias("shorter"))
    lower = levels.select((F.col("j") + 1).alias("j"), F.col("g").alias("shorter"), F.col("c").alias("c_shorter"))
    contexts = (
        upper.join(lower, ["j", "shorter"], "left")
        .groupBy("j", F.shiftright("g", 8).alias("context"))
        .agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("d"), F.sum(F.coalesce("c_shorter", F.lit(0))).alias("e"))
    )
    contexts = stored(contexts, "ppm-contexts")
    top = levels.where(F.col("j") == order).select(F.col("g").alias("gram"), "c", F.shiftright("g", 8).alias("context"))
    known = top.join(contexts.where(F.col("j") == order), "context").select(
        "gram", F.log10(F.col("c") / (F.col("t") + F.col("d"))).alias("value")
    )
    unseen = asked.join(top.select("gram"), "gram", "left_anti")
    # contexts (kind 0) and grams (kind 1) of every order, in one table and one join
    nodes = contexts.select(_key(0, F.col("j"), F.col("context")).alias("key"), "t", "d", "e").unionByName(
        levels.select(_key(1, F.col("j"), F.col("g")).alias("key"), F.col("c").alias("t"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("e"))
    )
    looked = []
    for j in range(order + 1):
        looked.append(F.struct(F.lit(j).alias("at"), _key(0, j, F.shiftright(F.col("gram").bitwiseAND(F.lit(masks[j])), 8)).alias("key")))
        looked.append(F.struct(F.lit(16 + j).alias("at"), _key(1, j, F.col("gram").bitwiseAND(F.lit(masks[j]))).alias("key")))
    lookups = unseen.select("gram", F.explode(F.array(*looked)).alias("x")).select("gram", "x.at", "x.key")
    found = lookups.join(nodes, "key", "left")
    zero = F.lit(0)
    wide = found.groupBy("gram").agg(
        *[F.coalesce(F.max(F.when(F.col("at") == j, F.col(c))), zero).alias(f"{c}{j}") for j in range(order + 1) for c in "tde"],
        *[F.coalesce(F.max(F.when(F.col("at") == 16 + j, F.col("t"))), zero).alias(f"c{j}") for j in range(order + 1)],
    )
    # from the longest context down: what the longer one has excluded, and the escapes so far
    value, escapes, open_ = F.lit(None).cast("double"), F.lit(0.0), F.lit(True)
    gone, mass = zero, zero
    for j in range(order, -1, -1):
        fresh = F.col(f"d{j}") - gone
        total = F.col(f"t{j}") - mass + fresh
        here = (F.col(f"d{j}") > 0) & (fresh > 0)
        hit = here & (F.col(f"c{j}") > 0)
        value = F.when(F.col(f"c{j}") > 0, F.coalesce(value, F.when(hit, escapes + F.log10(F.col(f"c{j}") / total)))).otherwise(value)
        escapes = escapes + F.when(here, F.log10(fresh / total)).otherwise(F.lit(0.0))
        gone, mass = F.when(F.col(f"d{j}") > 0, F.col(f"d{j}")).otherwise(gone), F.col(f"e{j}")
        wide = wide.withColumns({f"v{j}": value, f"s{j}": escapes, f"g{j}": gone, f"m{j}": mass})
        value, escapes, gone, mass = (F.col(f"{x}{j}") for x in "vsgm")
    value = F.coalesce(value, escapes - F.log10(256 - gone))
    return known.unionByName(wide.select("gram", value.alias("value")))


def score_documents(docs: DataFrame, training: Column, order: int = ORDER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``score`` is the log10 probability of the whole text under the trie learned from the
    documents that ``training`` admits; ``base_score`` that of its words under their
    add-one frequencies there.
    """
    blocks, count = _blocks(docs, training, key, text)
    facts = stored(block_facts(blocks, count, order), "ppm-facts")
    grams = facts.where("gram is not null")
    counts = stored(grams.groupBy("gram").agg(F.sum("n").alias("c")), "ppm-grams")
    scores = gram_scores(counts.select("gram"), counts.where("c > 0"), order)
    words = facts.where("word is not null")
    vocabulary = stored(words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "ppm-words")
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, below = size.n, math.log10(size.n + size.v + 1)
    empty = {"gram": F.lit(None).cast("long"), "value": F.lit(None).cast("double"), "word": F.lit(None).cast("binary"),
             "doc_id": F.lit(None).cast("long"), "training": F.lit(None).cast("boolean"), "text": F.lit(None).cast("binary")}
    order_of = ["block", "kind", *empty]

    def shaped(df, kind, **columns):
        return df.select(*[{**empty, "block": F.col("block"), "kind": F.lit(kind), **columns}[c].alias(c) for c in order_of])

    answers = shaped(grams.select("block", "gram").join(scores, "gram"), 0, gram=F.col("gram"), value=F.col("value"))
    known = shaped(words.select("block", "word").join(vocabulary, "word"), 1, word=F.col("word"), value=F.log10(F.col("c") + 1.0) - below)
    texts = shaped(blocks, 2, doc_id=F.col("doc_id").cast("long"), training=F.col("training"), text=F.col("text"))
    dealt = answers.unionByName(known).unionByName(texts).repartition(count, "block").sortWithinPartitions("block", "kind")
    out = pa.schema([("doc_id", pa.int64()), ("training", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, grams, values, table, known = None, [], [], None, {}
        for rows in batches:
            blocks_, kinds = rows["block"].to_numpy(), rows["kind"].to_numpy()
            cuts = np.flatnonzero((blocks_[1:] != blocks_[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(kinds)]):
                if blocks_[a] != block:
                    block, grams, values, table, known = blocks_[a], [], [], None, {}
                part = rows.slice(a, b - a)
                if kinds[a] == 0:
                    grams.append(part["gram"].to_numpy())
                    values.append(part["value"].to_numpy())
                elif kinds[a] == 1:
                    known.update(zip(part["word"].to_pylist(), part["value"].to_pylist()))
                else:
                    if table is None:
                        g, v = np.concatenate(grams), np.concatenate(values)
                        by = np.argsort(g)
                        table, grams, values = (g[by], v[by]), [], []
                    yield score(part, table, known)

    def score(part, table, known):
        texts = part["text"].to_pylist()
        totals = np.zeros(len(texts))
        for owners, code in segments(texts, order):
            totals += np.bincount(owners, table[1][np.searchsorted(table[0], code)], len(texts))
        n_tokens, n_known, base = [], [], []
        for text in texts:
            found = list(map(known.get, [*text.lower().split(), END_WORD]))
            unknown = found.count(None)
            n_tokens.append(len(found))
            n_known.append(len(found) - unknown)
            base.append(math.fsum(found if not unknown else [x for x in found if x is not None]) - unknown * below)
        return pa.record_batch(
            [part["doc_id"], part["training"], pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([n_train] * len(texts), pa.int64()), pa.array(base, pa.float64()), pa.array(totals)],
            schema=out,
        )

    return dealt.mapInArrow(run, "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_adaptively(docs: DataFrame, order: int = ORDER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): each text coded by a trie that starts empty and learns from that text alone."""

    def run(batches):
        def rows():
            for batch in batches:
                for doc, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                    yield doc, Trie(order).walk(value.as_py(), True)

        yield from batches_of(rows(), pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))

    return docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text")).mapInArrow(run, "doc_id long, score double")
