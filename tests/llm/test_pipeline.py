"""The pipeline stage by stage, and the registered queries, against brute force on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from test_exact import WHITE
from test_minhash import expected

import __spark_entry__ as entry_points
import corpus_pipeline
from seriesloom.llm import quality, queries
from seriesloom.llm.common import join_groups, table

SF = "/root/testdata/sf0.001"


def test_registered(spark):
    names = entry_points.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "null" if v is None else repr(v) if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    df, result = queries.QUERIES[name](spark, SF), db.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.columns, df.collect()) == plain(columns, result.fetchall())


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = table(spark, SF, "documents").withColumn("score", F.lit("x")).cache()
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF).cache()
    assert good.columns == docs.columns
    model = quality.fit(docs, table(spark, SF, "labels"))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in docs.collect() if quality.score_of(model, r.text) >= 0.3}
    once = stages["exact dedup"](spark, good, SF).cache()
    best = {}
    for r in good.collect():
        key = WHITE.sub("", r.text)
        best[key] = min(best.get(key, (0, 10**9)), (-len(r.text), r.doc_id))
    assert once.columns == docs.columns and {r.doc_id for r in once.collect()} == {d for _, d in best.values()}
    apart = stages["MinHash near-dedup"](spark, once, SF).cache()
    heads = {eval(x)[2] for x in expected([(r.doc_id, r.text) for r in once.collect()])}
    assert apart.columns == docs.columns and {r.doc_id for r in apart.collect()} == heads
    mixed = stages["mixing sources to target weights"](spark, apart, SF).cache()
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) == 2
    last = stages["BPE encoding and decoding"](spark, mixed, SF)
    assert Counter(r.doc_id for r in last.collect()) == Counter(r.doc_id for r in mixed.collect())


def test_pipeline_of_hard_rows(spark, hard, nothing):
    for docs in (hard, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()
    kept = corpus_pipeline.without_copies(spark, hard, SF).collect()
    assert len(kept) == len({WHITE.sub("", r.text or "") for r in hard.collect()})


def test_join_groups_with_hot_and_plain_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.min("id").alias("first"))
    joined = join_groups(rows, groups, ["k"]).collect()
    assert len(joined) == 5000 and all(r.first == (0 if r.k == 0 else r.k) for r in joined)
