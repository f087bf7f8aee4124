"""The operators' queries against DuckDB where SQL can express them; all run whole."""

from types import SimpleNamespace

import duckdb
import pytest

import corpus_pipeline
from scriptorium.llm import base, queries


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(repr(round(r[k], 9)) if isinstance(r[k], float) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, data, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    df = queries.QUERIES[name](spark, data)
    found = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.collect(), df.columns) == ordered(found.fetchall(), columns)


def test_mixing_against_sql_where_values_have_no_target(spark, data, tmp_path):
    duck = duckdb.connect()
    duck.execute(f"""COPY (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'it' ELSE lang END AS lang,
      CASE WHEN doc_id % 5 = 0 THEN 'web' WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, n_chars FROM '{data}/documents.parquet') TO '{tmp_path}/documents.parquet'""")
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    df = queries.QUERIES["op2_mixing"](spark, str(tmp_path))
    found = duck.execute(queries.ORACLE_SQL["op2_mixing"])
    assert ordered(df.collect(), df.columns) == ordered(found.fetchall(), [c[0] for c in found.description])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", ["op4_avi_mjpeg", "op5_suffix_dedup", "op8_line_crf", "op9_language_id"])
def test_a_row_for_each_document(spark, data, name):
    found = queries.QUERIES[name](spark, data)
    ids = sorted(r["doc_id"] for r in found.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id").collect())


def test_pipeline_runs(spark, data):
    pieces = corpus_pipeline.run(spark, data)
    assert pieces.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "mixing", "packing"]


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        base.shared_dir(cluster)


def test_small_batches_respect_smaller_settings():
    held = {"spark.sql.execution.arrow.maxRecordsPerBatch": "200", "spark.sql.execution.arrow.maxBytesPerBatch": "67108864b"}
    session = SimpleNamespace(conf=SimpleNamespace(get=held.get, set=held.__setitem__))
    base.small_batches(session)
    assert list(held.values()) == ["200", "16m"]
