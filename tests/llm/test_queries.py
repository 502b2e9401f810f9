"""Registered queries: equal to their SQL, and defined on empty tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from delivery_marts.llm import shared, token_files
from delivery_marts.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF_DIR, empty_like, own_tables
from tools.compare import open_tables, results


def test_all_thirteen_and_the_pipeline_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    got, want = results(spark, open_tables(SF_DIR), name, SF_DIR)
    assert got == want
    assert got[1]


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables_give_empty_results(spark, tmp_path, name):
    empty = {t: empty_like(t) for t in ("documents", "embeddings", "labels", "conversations")}
    rows = queries()[name](spark, own_tables(tmp_path, **empty)).collect()
    assert [r.conv_id for r in rows] == [-1] if name == "op4_chat" else rows == []


@pytest.mark.parametrize("name", ["op3_mixing", "op4_chat", "op6_sharding"])
def test_native_plans_stay_in_the_jvm(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]


def test_folders_are_shared_and_can_be_cleared(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    kept = shared.written(spark.range(3), "kept")
    assert any("llm-kept" in path for path in kept.inputFiles()) and root in kept.inputFiles()[0]
    monkeypatch.setattr(shared, "_MADE", {spark.sparkContext.applicationId: [kept.inputFiles()[0].rpartition("/")[0]]})
    shared.clear(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(kept.inputFiles()[0]).count()


def test_token_files_also_below_the_warehouse(tmp_path):
    system, path = token_files._open(f"file:{tmp_path}/x")
    assert path == f"{tmp_path}/x" and system.type_name == "local"
