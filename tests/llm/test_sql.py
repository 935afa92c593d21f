"""The registered queries and the pipeline on the smallest tables: SQL where it exists, plain Python elsewhere."""

import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from adjudica.llm import queries, shared
from conftest import DATA

TABLES = ("documents", "benchmark", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    relation = con.sql(queries.ORACLES[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert ours == sorted(repr(tuple(r[i] for i in order)) for r in relation.fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "benchmark", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        assert name == "tokens" or docs.columns == columns
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert len(ids["language_id"]) == 200
    found = queries.op5_near_dedup(spark, DATA).where("kept").collect()
    assert sorted(ids["near_duplicates"]) == sorted(r.doc_id for r in found)
    leaks = {r.doc_id for r in queries.op4_decontaminate(spark, DATA).collect()}
    assert sorted(ids["benchmark"]) == sorted(set(ids["near_duplicates"]) - leaks)
    assert set(ids["mix"]) <= set(ids["benchmark"]) and max(map(ids["mix"].count, ids["mix"])) <= 2
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for r in seen["mix"]:
        data = np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        want.append((r.doc_id, len(data) // 4, zlib.crc32(data)))
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in seen["tokens"]) == sorted(want)
    starts = sorted((r.start, r.n_tokens) for r in seen["tokens"])
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0


@pytest.mark.parametrize("stage", ["language_id", "near_duplicates", "benchmark", "tokens"])
def test_long_texts_reach_the_workers_of_a_stage_in_small_batches(spark, stage):
    limit = shared._BATCH_LIMIT
    rows = [(i, f"{i} " + "some words " * 2000, "en", "web", 0) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    try:
        spark.conf.unset(limit)
        before = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
        dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(3), DATA)
        after = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
        spark.conf.set(limit, "2m")  # a session's own limit holds
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(limit) == "2m"
    finally:
        spark.conf.unset(limit)
    assert max(before) > 15_000_000 and max(after) < 4_500_000


def test_a_task_gives_back_what_arrow_does_not_use(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            Pool.released += 1

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    work = shared.releasing(lambda batches: (b for b in batches))
    batches = work(iter([1, 2]))
    assert next(batches) == 1 and Pool.released == 0
    assert list(batches) == [2] and Pool.released == 1
