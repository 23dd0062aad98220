"""Repeated columns against plain comparison of all pairs."""

from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import duplicates as D


def plain(pdf, key):
    out = {}
    for a, b in combinations([c for c in pdf.columns if c != key], 2):
        text = [pdf[c].dtype == object for c in (a, b)]
        if text[0] != text[1]:
            continue
        both = pdf[a].notna() & pdf[b].notna()
        x, y = pdf.loc[both, a], pdf.loc[both, b]
        if len(x) and (x == y).all():
            out[a, b] = ("copy" if (pdf[a].isna() == pdf[b].isna()).all() else "copy_where_present", len(x))
        elif not text[0] and x.nunique() > 1:
            if (x.rank() == y.rank()).all():
                out[a, b] = ("increasing", len(x))
            elif (x.rank() == (-y).rank()).all():
                out[a, b] = ("decreasing", len(x))
    return out


@pytest.mark.parametrize("look", [1_000, 5])
def test_every_kind_is_found(spark, monkeypatch, look):
    monkeypatch.setattr(D, "LOOK", look)
    rng = np.random.default_rng(2)
    n = 400
    x = np.round(rng.normal(size=n), 1)
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "log": np.exp(x), "minus": -2 * x, "steps": np.floor(x), "z": rng.normal(size=n), "one": 1.0, "uno": 1.0})
    pdf["same"], pdf["gaps"], pdf["near"] = pdf["x"], pdf["x"].where(pdf["id"] % 3 > 0), pdf["x"].where(pdf["id"] != 399, 7.0)
    pdf["low"], pdf["high"] = pdf["x"].where(pdf["id"] < 200), pdf["z"].where(pdf["id"] >= 200)
    pdf["name"], pdf["none"] = [f"n{i % 5}" for i in range(n)], np.nan
    pdf["label"] = pdf["name"]
    pdf["whole"], pdf["real"] = np.arange(n) % 9, (np.arange(n) % 9).astype(float)
    schema = ", ".join(f"{c} {'string' if c in ('name', 'label') else 'long' if c in ('id', 'whole') else 'double'}" for c in pdf.columns)
    rows = [tuple(None if v != v else (int(v) if c in ("id", "whole") else v) for c, v in zip(pdf.columns, r)) for r in pdf.astype(object).to_numpy()]
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = {(r["left_column"], r["right_column"]): (r["kind"], r["n_both"]) for r in D.duplicate_columns(df, "id").collect()}
    assert got == plain(pdf, "id")
    assert {k for k, _ in got.values()} == {"copy", "copy_where_present", "increasing", "decreasing"} and ("x", "near") not in got


def test_prints_do_not_depend_on_the_order_of_rows(spark):
    df = spark.createDataFrame([(i, i % 7, float(i % 7), str(i % 7), (i + 1) % 7) for i in range(100)], "id long, a int, b double, c string, d int")
    prints = D.column_prints(df, "id", ["a", "b", "c", "d"])
    assert prints["a"] == prints["b"] != prints["d"] and prints["c"][0] is False
    assert prints == D.column_prints(df.repartition(7), "id", ["a", "b", "c", "d"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, a int, b int, c string")
    assert D.duplicate_columns(df, "id").collect() == []
