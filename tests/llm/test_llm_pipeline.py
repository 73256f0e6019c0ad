"""The corpus pipeline and the registered queries, on the smallest tables and on awkward rows."""

import collections

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from conftest import SF
from test_llm_operators import (AWKWARD, SHAPE, check_packed, components_by_hand, cut_by_hand)
from vintora.llm.registry import ORACLE, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in order) for r in df.collect()) == sorted(result.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = {name: run for name, run in corpus_pipeline.STAGES}
    first = stage["language ID"](spark, docs, SF)
    assert first.columns == COLUMNS and first.count() == docs.count()
    kept = stage["MinHash near-dedup"](spark, first, SF)
    found = components_by_hand(pairs(first))
    assert sorted(i for i, _ in pairs(kept)) == sorted(i for i, _, c in found if i == c)
    cut = stage["substring dedup"](spark, kept, SF)
    assert cut.columns == COLUMNS and collections.Counter(pairs(cut)) == cut_by_hand(
        pairs(kept), whole_lines=True)
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    clean = stage["benchmark decontamination"](spark, cut, SF)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, t in pairs(cut) if any(item in t for item in items)}
    gone = {i for i, _ in pairs(cut)} - {i for i, _ in pairs(clean)}
    assert held <= gone and len(gone) <= len(held) + 1
    check_packed(stage["best-fit packing"](spark, clean, SF).collect(), pairs(clean), 2048)


def test_stages_on_awkward_rows(spark):
    names = [f.split()[0].strip("`") for f in SHAPE.split(", ")]
    rows = [dict.fromkeys(names, None) | {"doc_id": i, "text": t, "lang": "en", "size": 1, "row": "x"}
            for i, t in AWKWARD]
    docs = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SHAPE)
    for df in (docs, docs.limit(0)):
        for name, run in corpus_pipeline.STAGES:
            before = df
            df = run(spark, df, SF).checkpoint()
            if name != "best-fit packing":
                assert df.columns == before.columns and df.count() <= before.count()
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    ids = collections.Counter(i for i, _ in pairs(left))
    # Equal texts leave one row, the smallest id; rows without an id stay.
    assert ids[-3] == 1 and ids[7] == 0 and ids[8] == 0 and ids[None] == 2 and ids[5] == 1
