"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Character 1- to 3-grams of the lower-cased text are hashed into ``FEATURES`` columns.
Document frequencies come from every training document; the weights are fitted with
follow-the-regularised-leader and elastic-net penalties on a bounded sample per language
(about ``per_language`` documents of any length, drawn by digest), one fifth of which sets the
temperature. A drawn text reaches the fit as its n-gram counts, at most FEATURES; where these are more
than ``sample_entries`` a text on average, fewer texts are drawn, a quarter of ``per_language`` at least.
The model is a matrix of FEATURES x languages, which bounds what tasks receive.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for all
texts where no language can be learned; one learned language always scores 1; rows of
equal text get equal predictions; prediction reads only the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, draw_bound, raw_text, releasing, remainder_of_id

FEATURES = 1 << 14
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)
UNKNOWN = "und"


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns and counts of the character 1- to 3-grams of a text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    totals = np.zeros(FEATURES, np.int64)
    mixed = np.zeros(len(c), np.uint32)
    for n in range(min(3, len(c))):
        mixed = (mixed[: len(c) - n] ^ c[n:]) * _MULTIPLIERS[n]
        totals += np.bincount(mixed >> np.uint32(18), minlength=FEATURES)
    columns = np.flatnonzero(totals)
    return columns, totals[columns]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # FEATURES x languages
    bias: np.ndarray
    temperature: float

    def vector(self, columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = (1.0 + np.log(counts)) * self.idf[columns]
        norm = np.sqrt(values @ values)
        return columns, values / norm if norm else values

    def logits(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        columns, values = self.vector(columns, counts)
        return values @ self.weights[columns] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*ngram_counts(text)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows, labels, idf, languages, alpha=1.0, beta=1.0, l1=0.002, l2=0.0005, epochs=4) -> LanguageModel:
    """Follow the regularised leader, one document at a time; weights exist only where |z| exceeds l1."""
    k = len(languages)
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))
    shell = LanguageModel(languages, idf, z[:FEATURES], z[FEATURES], 1.0)
    vectors = []
    for counted in rows:
        columns, values = shell.vector(*counted)
        vectors.append((np.append(columns, FEATURES), np.append(values, 1.0)))

    def weights(at):
        zi, ni = z[at], n[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for (columns, values), label in zip(vectors, labels):
            w = weights(columns)
            error = softmax(values @ w)
            error[label] -= 1.0
            g = values[:, None] * error[None, :]
            grown = n[columns] + g * g
            z[columns] += g - (np.sqrt(grown) - np.sqrt(n[columns])) / alpha * w
            n[columns] = grown
    every = weights(np.arange(FEATURES + 1))
    return LanguageModel(languages, idf, every[:FEATURES], every[FEATURES], 1.0)


def calibrate(model: LanguageModel, rows, labels) -> LanguageModel:
    """The temperature that minimises the log loss of held-back rows (golden section on its logarithm)."""
    if not rows:
        return model
    logits, labels = np.stack([model.logits(*r) for r in rows]), np.asarray(labels)

    def loss(log_t):
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high, ratio = np.log(0.05), np.log(5.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return LanguageModel(model.languages, model.idf, model.weights, model.bias, float(np.exp((low + high) / 2)))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and how many hold each hashed n-gram; one array per task is added up."""
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for value in batch["text"]:
                totals[ngram_counts(value.as_py().decode("utf-8", "replace"))[0]] += 1
                rows += 1
        if rows:
            yield pa.record_batch([pa.array(range(-1, FEATURES), pa.int32()), pa.array([rows, *totals.tolist()], pa.int64())], schema=schema)

    counted = texts.mapInArrow(releasing(count), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES, np.int64)
    total = 0
    for r in counted:
        if r.feature < 0:
            total = r.n
        else:
            out[r.feature] = r.n
    return total, out


def counted_sample(sample: DataFrame) -> list[tuple[str, tuple[np.ndarray, np.ndarray]]]:
    """(lang, n-gram columns and counts) of the drawn texts, in the order of the draw; counted where the texts are."""
    schema = pa.schema([("lang", pa.string()), ("draw", pa.int64()), ("columns", pa.binary()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for lang, draw, value in zip(batch["lang"].to_pylist(), batch["draw"].to_pylist(), batch["text"]):
                    columns, counts = ngram_counts(value.as_py().decode("utf-8", "replace"))
                    yield lang, draw, columns.astype("<u2").tobytes(), counts.astype("<u4").tobytes()

        yield from batches_of(rows(), schema, 200)

    drawn = sample.select("lang", "draw", raw_text("text").alias("text")).distinct()
    found = drawn.mapInArrow(releasing(count), "lang string, draw long, columns binary, counts binary").collect()
    found.sort(key=lambda r: (r.draw, r.lang, r["columns"], r.counts))
    return [(r.lang, (np.frombuffer(r["columns"], "<u2").astype(np.int64), np.frombuffer(r.counts, "<u4").astype(np.int64))) for r in found]


def fit(
    docs: DataFrame,
    training: Column,
    per_language: int = 800,
    sample_entries: int = FEATURES // 4,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """Fit on the rows that ``training`` admits and whose language is not null."""
    rows = docs.select(
        F.col(key).cast("string").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), training.alias("use")
    ).where("use and lang is not null and text is not null")
    total, df = document_frequencies(rows.select(raw_text("text").alias("text")))
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    # draws below a bound per language: about per_language rows each, whatever the table's size
    usable = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("draw", F.xxhash64(F.lit("language"), "id", "text"))
    # a text has no more n-gram columns than FEATURES, and few texts have more than bytes
    entries = F.avg(F.least(F.octet_length("text"), F.lit(FEATURES)))
    facts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), entries.alias("entries")).collect()
    drawn = F.lit(False)
    for r in facts:
        bound = draw_bound(per_language * min(1.0, sample_entries / r.entries) / r.n)
        drawn = drawn | ((F.col("lang") == r.lang) & (F.col("draw") <= bound))
    sample = counted_sample(usable.where(drawn))
    languages = tuple(sorted({lang for lang, _ in sample}))
    at = {name: i for i, name in enumerate(languages)}
    fitted = [r for i, r in enumerate(sample) if i % 5]
    held = [r for i, r in enumerate(sample) if i % 5 == 0]
    model = fit_ftrl([r for _, r in fitted], [at[lang] for lang, _ in fitted], idf, languages) if languages else LanguageModel((), idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    return calibrate(model, [r for _, r in held], [at[lang] for lang, _ in held])


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, kept columns, lang_pred, score) for every document; the model travels with the tasks."""
    schema_of = docs.select(F.col(key).alias("doc_id"), *[F.col(f"`{c}`") for c in keep])
    lettered = F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.col(key).alias("doc_id"), *[F.col(f"`{c}`") for c in keep], raw_text(text).alias("_bytes"), lettered.alias("_lettered")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for value, lettered in zip(batch["_bytes"], batch["_lettered"].to_pylist()):
                lang, score = model.predict(value.as_py().decode("utf-8", "replace")) if lettered else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
            columns = [batch[i] for i in range(batch.num_columns - 2)]
            names = [*batch.schema.names[:-2], "lang_pred", "score"]
            yield pa.record_batch([*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*schema_of.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return rows.mapInArrow(releasing(run), schema)


def fit_predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held: int = 2, divisor: int = 4) -> DataFrame:
    """Learn from documents whose crc32(id) mod ``divisor`` is not ``held``; predict all."""
    held_out = remainder_of_id(key, divisor) == held
    model = fit(docs, ~held_out, key=key, text=text, lang=lang)
    return predict(docs, model, key, text).withColumn("held_out", remainder_of_id("doc_id", divisor) == held)


def keep_identified(docs: DataFrame, min_score: float = 0.4, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is identified with at least this calibrated probability."""
    held_out = remainder_of_id(key, 4) == 2
    model = fit(docs, ~held_out, key=key, text=text, lang=lang)
    columns = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    position = {c: f"c{i}" for i, c in enumerate(columns)}
    scored = predict(rows, model, position[key], position[text], keep=tuple(position.values()))
    kept = scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*position.values()).toDF(*columns)
