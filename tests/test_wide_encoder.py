"""Categorical columns of any width: label tables and sparse vectors give what listed categories give."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import encode, explain, models as M


@pytest.fixture(scope="module")
def rows(spark):
    """Values v0 .. v29, the higher the rarer, with NULLs; a second, narrow column."""
    df = spark.range(900).select("id", F.concat(F.lit("v."), F.floor(F.sqrt("id")).cast("string")).alias("c"), (F.col("id") % 3).cast("string").alias("d"), (F.col("id") / 7.0).alias("x"))
    return df.withColumn("c", F.when(F.col("id") % 11 > 0, F.col("c"))).withColumn("y", (F.col("id") % 5 < 2).cast("int")).cache()


def vectors(fitted, df):
    found = PipelineModel(fitted.stages()).transform(df).select("id", vector_to_array("features").alias("f"))
    return {r["id"]: r["f"] for r in found.collect()}


@pytest.mark.parametrize("least", [1, 20, 50, 10_000])
def test_wide_and_listed_agree(spark, rows, monkeypatch, least):
    fitted = encode.fit_encoder(rows, ["x"], ["c", "d"], min_frequency=least)
    odd = rows.unionByName(rows.limit(3).withColumns({"id": F.col("id") + 5000, "c": F.lit("never seen")}))
    assert not fitted.is_wide("c")
    listed = vectors(fitted, odd)
    monkeypatch.setattr(encode, "LISTED", 5)
    assert fitted.is_wide("c") and not fitted.is_wide("d")
    assert vectors(fitted, odd) == listed
    assert encode.encoded_names(PipelineModel(fitted.stages())) == [n.replace(".", "_") for n in fitted.feature_names()]


def test_wide_pipeline_saves_and_explains(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(encode, "LISTED", 5)
    candidate = M.make_candidates(["x"], ["c", "d"], "y", "entity", min_frequency=20, smaller={M.LOGREG: dict(iterations=50)})[M.LOGREG]
    model = candidate.fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    both = M.score(model, rows).select("id", "p").join(M.score(again, rows).select("id", F.col("p").alias("q")), ["id"])
    assert both.count() == 900 and both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] == 0
    assert encode.encoded_names(again) == encode.encoded_names(model)
    phis = explain.model_shap(again, rows, "id")
    logit = M.score(again, rows).select("id", F.log(F.col("p") / (1 - F.col("p"))).alias("z"))
    gap = phis.groupBy("id").agg(F.sum("phi").alias("s")).join(logit, ["id"]).select((F.col("z") - F.col("s")).alias("g"))
    assert gap.agg(F.max("g") - F.min("g")).first()[0] < 1e-6


def test_two_hundred_thousand_categories(spark):
    """Every value occurs once or twice; the plan holds none of them and a row's vector only its own."""
    df = spark.range(300_000).select("id", F.concat(F.lit("category-"), F.col("id") % 200_000).alias("c"))
    fitted = encode.fit_encoder(df, [], ["c"], min_frequency=2)
    assert len(fitted.kept["c"]) == 100_000 and len(fitted.rare["c"]) == 100_000
    model = fitted.model()
    out = model.transform(df)
    assert "category-123" not in out._jdf.queryExecution().toString()
    assert len(encode.encoded_names(model)) == 100_001
    found = {r["id"]: r["features"] for r in out.where("id IN (5, 200005, 150000)").collect()}
    assert {len(v) for v in found.values()} == {100_001} and all(v.numNonzeros() == 1 for v in found.values())
    assert found[5] == found[200005] and found[150000].indices[0] == 100_000
    assert model.transform(spark.createDataFrame([(1, "new")], "id long, c string")).first()["features"].numNonzeros() == 0
