"""The registered queries against their SQL, and the sources."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from riskframe.plans.queries import QUERIES
from riskframe.sources import io

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
# The llm subpackage has its own tests; fits that take a minute or more are left to the driver.
OWN = sorted(n for n in QUERIES if n in entry_point.oracle_sql())
SLOW = {"fit_gbt", "fit_gbt_subsampled", "fit_forest", "random_search", "select_k", "segment_entities", "train_save_rank", "ablation", "learning_curve"}
COMPARED = [n for n in OWN if n not in SLOW]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda x: None if isinstance(x, float) and math.isnan(x) else x
    return sorted(repr([clean(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.collect(), df.columns) == _rows(cursor.fetchall(), columns)


def test_every_query_has_sql():
    assert set(OWN) == set(QUERIES)


def test_dated_slices_reach_the_scan(spark):
    plan = QUERIES["enrich_slices"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders.parquet" in line]
    assert len(scans) >= 3 and all("GreaterThanOrEqual(o_orderdate" in line for line in scans)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


def test_scans_are_pruned_and_filtered(spark):
    plan = entry_point.queries()["scan_units_present"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan or "Not(EqualTo(o_orderstatus,P))" in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[1]


def test_materialize_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    for force in (False, False, True):
        assert io.materialize(spark, build, path, force).count() == 3
    assert len(calls) == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "k string, n int")
    io.write_csv(df, str(tmp_path / "c"), ["k"])
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert back.columns == ["k", "n"] and back.first()["k"] == "a"
    io.write_metrics(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.read_table(spark, str(tmp_path / "none"))


def test_nan_is_read_as_null(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(path)
    assert io.read_table(spark, path).where(F.col("x").isNull()).count() == 1
