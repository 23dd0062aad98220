"""Long runs that are lost midway go on where they ended."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_audit import df  # noqa: F401
from test_models import FAST, TASK

from riskframe.operators import models as M
from riskframe.plans import training
from riskframe.sources.ledger import Ledger, fingerprint

SMALL = {M.LOGREG: dict(iterations=30), M.GBT: dict(iterations=3, rate=0.3, leaves=7, min_rows=10)}


class Lost(Exception):
    pass


@pytest.fixture
def fits(monkeypatch):
    """Counts fits; ``stop`` loses the run at that one."""
    state = {"n": 0, "stop": None}
    plain = M.Candidate.fit_encoded

    def counted(self, *args):
        state["n"] += 1
        if state["n"] == state["stop"]:
            raise Lost
        return plain(self, *args)

    monkeypatch.setattr(M.Candidate, "fit_encoded", counted)
    return state


def test_fingerprint_tells_rows_apart(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    assert fingerprint(a) == fingerprint(a.orderBy(F.desc("k")).repartition(3))
    assert len({fingerprint(d) for d in (a, a.distinct(), a.limit(0), a.withColumn("k", F.col("k") + 1), a.withColumnRenamed("v", "w"))}) == 5


def test_parts_are_whole_or_absent(spark, tmp_path):
    ledger, key, calls = Ledger(spark, str(tmp_path)), {"a": 1}, []

    def broken():
        calls.append(1)
        return spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))

    with pytest.raises(Exception, match="lost"):
        ledger.table(key, broken)
    assert not ledger.done(key)
    for _ in range(2):
        assert ledger.table(key, lambda: calls.append(2) or spark.range(5)).count() == 5
    assert calls == [1, 2] and ledger.value({"b": 1}, lambda: {"x": [1]}) == {"x": [1]}
    assert {r["key"] for r in ledger.entries().collect()} == {'{"a":1}', '{"b":1}'}


def test_comparison_goes_on_after_a_loss(spark, df, tmp_path, fits):  # noqa: F811
    made = {n: c for n, c in M.make_candidates(["a", "b"], ["c"], "y", "entity", smaller=SMALL).items() if n in (M.DUMMY, M.LOGREG, M.GBT)}
    rows = lambda ledger: sorted(map(tuple, M.cross_validate(made, df, "id", "y", 3, ledger=ledger).collect()))
    expected, whole = rows(None), fits["n"]
    assert whole == 6
    fits.update(n=0, stop=4)
    with pytest.raises(Lost):
        rows(Ledger(spark, str(tmp_path)))
    before = Ledger(spark, str(tmp_path)).entries().count()
    fits.update(n=0, stop=None)
    assert rows(Ledger(spark, str(tmp_path))) == expected
    assert 0 < fits["n"] < whole and 0 < before < 9
    fits.update(n=0)
    assert rows(Ledger(spark, str(tmp_path))) == expected and fits["n"] == 0
    # Other rows and other settings are other parts.
    made[M.GBT] = made[M.GBT].copy({made[M.GBT].param("stepSize"): 0.2})
    rows(Ledger(spark, str(tmp_path)))
    assert fits["n"] == 3


def stages(spark, folder):
    return {r["stage"] for r in Ledger(spark, folder).entries().select(F.get_json_object("key", "$.stage").alias("stage")).collect()} - {None}


@pytest.mark.parametrize("grain", ["entity", "unit"])
def test_run_goes_on_after_a_loss(spark, df, tmp_path, fits, monkeypatch, grain):  # noqa: F811
    rows = df.select("id", F.col("a").alias("outcome_t1"), F.col("b").alias("ctx"), F.col("c").alias("grp"), (F.col("id") % 30).alias("entity"), "y")
    cfg = replace(FAST, candidates=(M.DUMMY, M.GBT), curve_sizes=(1, 2))
    task, folder = replace(TASK, grain=grain), str(tmp_path / "run")
    train = training.train_units if grain == "unit" else training.train_entities
    # The unit run is lost in its last stage, the entity run in the ablation.
    late = "entity_aggregate" if grain == "unit" else "ablate_history"

    def lost(*args):
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(training, late, lost)
        with pytest.raises(Lost):
            train(rows, task, cfg, folder=folder)
    done = stages(spark, folder)
    assert {"split", "compare", "search", "model", "holdout_scores", "thresholds", "holdout"} <= done
    fits.update(n=0)
    result = train(rows, task, cfg, folder=folder)
    assert fits["n"] == (0 if grain == "unit" else 1 + cfg.cv_folds)  # the ablation fits anew, nothing else does
    assert len(stages(spark, folder) - done) == 1
    fresh = train(rows, task, cfg)
    # Sums of doubles differ in their last digits with the order of rows.
    plain = lambda t: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in t.collect())
    for a, b in ((result.cv, fresh.cv), (result.holdout, fresh.holdout), (result.search, fresh.search)):
        assert plain(a) == plain(b)
    assert result.params == fresh.params and result.thresholds == pytest.approx(fresh.thresholds)
