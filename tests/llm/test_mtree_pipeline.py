import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airmesh.llm import mtree, queries

from ..conftest import SF_ORACLE, SF_SMALL


def by_brute_force(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in good), default=0)
    points = np.array([[math.floor(64 * x) for x in v] + [0] * (width - len(v)) for _, v in good], dtype=np.int64).reshape(len(good), width)
    out = Counter()
    for n, (query_id, _) in enumerate(good):
        if query_id % 20 == 0:
            scores = points @ points[n]
            order = sorted((i for i in range(len(good)) if i != n), key=lambda i: (-scores[i], good[i][0]))[:k]
            out.update((query_id, r, good[i][0], int(scores[i])) for r, i in enumerate(order, 1))
    return out


@pytest.mark.parametrize("limits", [(64, 4096, 128, 1024), (3, 40, 8, 5), (1, 10_000, 1000, 10_000)])
def test_top_k_equals_brute_force(spark, monkeypatch, limits):
    rnd = np.random.default_rng(2)
    rows = [(int(i), v.tolist()) for i, v in enumerate(rnd.normal(size=(300, 6)))]
    rows += [(i, [1.0, 0.0, 0.5, 0.0, 0.0, 0.0]) for i in range(300, 420)]  # one very common vector
    rows += [(500, None), (520, [1.0, None, 0.0]), (540, [math.inf, 0.0]), (560, [math.nan]), (580, []), (600, [1.0, 2.0]), (None, [1.0]),
             (20, [0.1] * 6), (620, [0.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    for name, value in zip(("PIVOTS", "TREE_ROWS", "PAGE_ROWS", "QUERY_ROWS"), limits, strict=True):
        monkeypatch.setattr(mtree, name, value)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for k in (20, 1000):
        assert Counter(map(tuple, mtree.top_k(df, k, F.col("vec_id") % 20 == 0).collect())) == by_brute_force(rows, k)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.top_k(none, 20, F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF_SMALL)
    said = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in said.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, said.fetchall())) == Counter(map(tuple, got.select(*columns).collect()))


CONTRACT = {
    "op1_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op2_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op6_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op7_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op9_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op11_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
    "op12_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint",
                           "base_failed": "boolean", "kept": "boolean"},
    "op13_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
    "op10_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contracts(spark, name):
    got = dict(queries.QUERIES[name](spark, SF_SMALL).dtypes)
    assert {c: got.get(c) for c in CONTRACT[name]} == CONTRACT[name]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    columns, start = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_ORACLE)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= start and out.columns[:len(columns)] == columns
        if name != "sharding":
            assert out.columns == columns
        if name in ("language", "near_duplicates", "decontamination"):
            assert len(ids) >= 0.9 * len(start)
        docs = corpus_pipeline.stored(out, f"test-{name}")
        start = ids
    assert docs.groupBy("shard").count().count() == corpus_pipeline.SHARDS


def test_pipeline_of_odd_and_no_documents(spark, odd, empty):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF_SMALL), f"test-{name}")
            assert docs.columns[:len(columns)] == columns
        assert docs.count() >= 0


def _tables(spark):
    import os

    folder = f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/airmesh-tables"
    return {f for f in os.listdir(folder) if f.startswith("llm-")}


def test_stages_leave_no_tables_behind(spark):
    corpus_pipeline.stored(spark.range(1), "test-folder")
    before = _tables(spark)
    rows = corpus_pipeline.run(spark, SF_SMALL)
    left = _tables(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("llm-pipeline-sharding")
    assert rows.count() > 0


def test_a_stage_keeps_what_its_input_reads(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    thinned = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)  # not written: its tables are still read
    assert corpus_pipeline.decontamination(spark, thinned, SF_SMALL).count() > 0


def test_columns_named_like_helpers_survive(spark):
    rows = [(1, "a b c d e f g", "s", 7, "x", 5, 1.5), (1, "a b c d e f g", "s", 8, "y", 6, 2.5), (2, None, None, 9, None, None, None),
            (2, None, None, 9, None, None, None), (3, "q r s t u v w", "s", 1, "z", 0, 0.0), (None, "q r s t u v w", "s", 2, "z", 0, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `_scan_row` long, pieces string, `_whole` long, `my col` double")
    df = df.withColumn("_name", F.col("_scan_row") + 1).withColumn("_mix_row", F.lit("m"))
    thinned = corpus_pipeline.near_duplicates(spark, df, SF_SMALL)
    assert thinned.columns == df.columns
    got = thinned.collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 2, 3]  # equal texts once, the smallest id; texts without words all
    assert {r._scan_row for r in got if r.doc_id == 1} <= {7, 8} and all(r._name == r._scan_row + 1 for r in got)
    mixed = corpus_pipeline.mixing(spark, df, SF_SMALL)
    assert mixed.columns == df.columns
    assert all((r._scan_row, r.pieces) in {(7, "x"), (8, "y"), (1, "z"), (2, "z")} for r in mixed.collect())


def test_names_with_blanks_and_dots_survive(spark):
    rows = [(1, "some words of a text", "en", "s", 1.5, (7, "x"), "d"), (2, "12 34", None, None, None, None, None), (None, "other words", "en", "t", 0.0, (8, None), "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `my col` double, `a part` struct<`one field`: long, other: string>, `dot.ted` string")
    df, rows = df.withColumn("_scan_row", F.lit("own")), [(*r, "own") for r in rows]
    kept = corpus_pipeline.language(spark, df, SF_SMALL)
    assert kept.columns == df.columns and {tuple(r) for r in kept.collect()} == {rows[0], rows[2]}
    dealt = corpus_pipeline.sharding(spark, df, SF_SMALL)
    assert dealt.columns[:len(df.columns)] == df.columns and {tuple(r)[:len(df.columns)] for r in dealt.collect()} == set(rows)
