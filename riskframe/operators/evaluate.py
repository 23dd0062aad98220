"""Evaluation of scores for a binary label; class 0 is the risk class.

Input: a label column ``y`` in {0, 1} and a score column ``p`` in [0, 1]. Most operators
take ``by`` columns and then give one result per group, so that folds, candidates or
permuted copies are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ordered import running_totals, with_bucket
from riskframe.sources.io import shared_folder

# Order of the metric columns in result tables.
METRIC_ORDER = [
    "roc_auc", "pr_auc", "pr_auc_risk", "f1", "f1_risk",
    "balanced_accuracy", "accuracy", "precision", "recall",
    "precision_risk", "recall_risk", "brier", "log_loss",
]
# Metrics of a cross-validation report.
CV_METRICS = ["roc_auc", "pr_auc", "f1", "balanced_accuracy", "brier"]
# 199 quantile steps of the threshold grid, and the default cost ratio.
GRID_STEPS = [float(q) for q in np.linspace(0.005, 0.995, 199)]
COST_MISS, COST_ALARM = 5.0, 1.0
CLIP = 1e-15


def score_violations(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: rows, missing labels or scores, labels outside {0, 1}, scores outside [0, 1]."""
    score = F.col(p).cast("double")
    missing = F.col(y).isNull() | F.col(p).isNull() | F.isnan(score)
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        count(missing).alias("n_missing"),
        count(F.coalesce(~F.col(y).isin(0, 1), F.lit(False))).alias("n_bad_label"),
        count(F.coalesce(~F.isnan(score) & ((score < 0) | (score > 1)), F.lit(False))).alias("n_out_of_range"),
    )


def checked(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """``df`` itself; the job that reads its scores fails at a label other than 0 or 1, or a score that is
    missing or outside [0, 1]. The check is part of the score column, so it takes no pass of its own."""
    good = F.coalesce(F.col(y).isin(0, 1) & F.col(p).cast("double").between(0, 1), F.lit(False))
    text = F.concat(F.lit("invalid label or score: "), F.to_json(F.struct(F.col(y), F.col(p))))
    return df.withColumn(p, F.when(good, F.col(p)).otherwise(F.raise_error(text).cast(df.schema[p].dataType)))


# -- ranking metrics ---------------------------------------------------------------------


def score_totals(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Distinct (by, p) with ``pos`` and ``neg`` counts and their running totals from below."""
    counts = checked(df, y, p).select(
        *by, p, F.col(y).cast("long").alias("pos"), (1 - F.col(y)).cast("long").alias("neg")
    )
    return running_totals(counts, p, ["pos", "neg"], by)


def distinct_scores(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """``score_totals`` written to the shared folder: thresholds and bins then never read the scores again."""
    shared_folder(df.sparkSession)
    return score_totals(df, y, p).checkpoint()


def _above(m: str) -> Column:
    """Rows of class ``m`` scored strictly higher."""
    return F.col(f"{m}_all") - F.col(f"{m}_upto")


def _per_pair(c: Column) -> Column:
    """Divided by the number of (positive, negative) pairs; NULL if a class is absent."""
    pairs = F.first("pos_all").cast("double") * F.first("neg_all").cast("double")
    return F.try_divide(c, pairs)


def _ranking_sums() -> list[Column]:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    won = neg * (_above("pos").cast("double") + pos / 2)
    tp, fp = _above("pos") + F.col("pos"), _above("neg") + F.col("neg")
    step = pos / F.col("pos_all") * tp / (tp + fp)
    step_risk = neg / F.col("neg_all") * F.col("neg_upto") / (F.col("neg_upto") + F.col("pos_upto"))
    two_classes = (F.col("pos_all") > 0) & (F.col("neg_all") > 0)
    return [
        _per_pair(F.sum(won)).alias("roc_auc"),
        F.sum(F.when(two_classes, step)).alias("pr_auc"),
        F.sum(F.when(two_classes, step_risk)).alias("pr_auc_risk"),
    ]


def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC and both average precisions per group, all from one ordering of the scores.

    Ties count one half in the AUC. ``pr_auc`` steps through the scores from the top for
    class 1, ``pr_auc_risk`` from the bottom for class 0. NULL where a class is absent.
    """
    return score_totals(df, y, p, by).groupBy(*by).agg(*_ranking_sums())


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    tp, fp = _above("pos") + F.col("pos"), _above("neg") + F.col("neg")
    return score_totals(df, y, p, by).select(
        *by,
        F.col(p).alias("threshold"),
        F.try_divide(fp.cast("double"), F.col("neg_all")).alias("fpr"),
        F.try_divide(tp.cast("double"), F.col("pos_all")).alias("tpr"),
    )


def pr_curve(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """(threshold, recall, precision) at every distinct score."""
    tp, fp = _above("pos") + F.col("pos"), _above("neg") + F.col("neg")
    return score_totals(df, y, p, by).select(
        *by,
        F.col(p).alias("threshold"),
        F.try_divide(tp.cast("double"), F.col("pos_all")).alias("recall"),
        F.try_divide(tp.cast("double"), tp + fp).alias("precision"),
    )


# -- metrics at a threshold --------------------------------------------------------------


# Counts and errors are sums over rows or, with the class counts ``pos`` and ``neg`` of
# each distinct score at hand, over distinct scores.


def _cell_counts(threshold: Column, p: str, pos: Column, neg: Column) -> list[Column]:
    flagged = F.col(p) >= threshold
    zero = F.lit(0).cast("long")
    cells = {"tn": (neg, ~flagged), "fp": (neg, flagged), "fn": (pos, ~flagged), "tp": (pos, flagged)}
    return [F.sum(F.when(where, c).otherwise(zero)).alias(name) for name, (c, where) in cells.items()]


def _mean_errors(p: str, pos: Column, neg: Column) -> list[Column]:
    score = F.col(p).cast("double")
    kept = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), score))
    squares = pos * (1 - score) * (1 - score) + neg * score * score
    losses = -pos * F.log(kept) - neg * F.log(1 - kept)
    n = F.sum(pos + neg)
    return [F.try_divide(F.sum(squares), n).alias("brier"), F.try_divide(F.sum(losses), n).alias("log_loss")]


def _classes(y: str) -> tuple[Column, Column]:
    """1 and 0 as counts of the two classes in one row."""
    return F.col(y).cast("long"), (1 - F.col(y)).cast("long")


def _in_words(cells: DataFrame, threshold: Column) -> DataFrame:
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cells.withColumns(
        {
            "threshold": threshold,
            "n": n,
            "prevalence": F.try_divide((F.col("fn") + F.col("tp")).cast("double"), n),
            "miss_risk": F.col("fp"),
            "false_alarm": F.col("fn"),
        }
    )


CELLS = ["threshold", "n", "prevalence", "tn", "fp", "fn", "tp", "miss_risk", "false_alarm"]


def confusion(
    df: DataFrame, threshold: float = 0.5, y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Per group: tn, fp, fn, tp at ``p >= threshold``, in words too, with n and prevalence."""
    cut = F.lit(float(threshold))
    return _in_words(checked(df, y, p).groupBy(*by).agg(*_cell_counts(cut, p, *_classes(y))), cut).select(*by, *CELLS)


def _share(part: Column, whole: Column) -> Column:
    """Quotient that is 0 over an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def with_rates(cells: DataFrame) -> DataFrame:
    """Add the rates of both classes to rows holding tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    pos_recall = F.try_divide(tp.cast("double"), tp + fn)
    neg_recall = F.try_divide(tn.cast("double"), tn + fp)
    # Mean recall over the classes that occur.
    balanced = F.coalesce((pos_recall + neg_recall) / 2, pos_recall, neg_recall)
    return cells.withColumns(
        {
            "f1": _share(2 * tp, 2 * tp + fp + fn),
            "f1_risk": _share(2 * tn, 2 * tn + fp + fn),
            "balanced_accuracy": balanced,
            "accuracy": _share(tn + tp, tn + fp + fn + tp),
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "precision_risk": _share(tn, tn + fn),
            "recall_risk": _share(tn, tn + fp),
        }
    )


def brier_logloss(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error and mean negative log-likelihood of the scores."""
    return checked(df, y, p).groupBy(*by).agg(*_mean_errors(p, *_classes(y)))


def evaluate(
    df: DataFrame, threshold: float = 0.5, y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Every metric of METRIC_ORDER plus the confusion cells, one row per group.

    All from the distinct scores with their class counts: one aggregation after one ordering.
    """
    cut, counts = F.lit(float(threshold)), (F.col("pos"), F.col("neg"))
    sums = score_totals(df, y, p, by).groupBy(*by).agg(
        *_ranking_sums(), *_cell_counts(cut, p, *counts), *_mean_errors(p, *counts)
    )
    return with_rates(_in_words(sums, cut)).select(*by, *METRIC_ORDER, *CELLS)


def evaluate_at(
    df: DataFrame, name: str, cuts: Sequence[tuple[str, str, float]], y: str = "y", p: str = "p"
) -> DataFrame:
    """Metrics of several scorers at several cuts: rows (label, metrics).

    ``cuts`` lists (scorer, label, threshold); ``name`` is the column that names the scorer.
    Scores are ordered once per scorer; only the distinct ones meet the cuts.
    """
    listed = F.array(
        *[F.struct(F.lit(a).alias("_of"), F.lit(b).alias("label"), F.lit(float(t)).alias("_cut")) for a, b, t in cuts]
    )
    mine = F.filter(listed, lambda c: c["_of"] == F.col(name))
    totals = score_totals(df, y, p, [name]).withColumn("_c", F.explode(mine)).select("*", "_c.label", "_c._cut")
    counts = (F.col("pos"), F.col("neg"))
    sums = totals.groupBy("label", "_cut").agg(
        *_ranking_sums(), *_cell_counts(F.col("_cut"), p, *counts), *_mean_errors(p, *counts)
    )
    return with_rates(_in_words(sums, F.col("_cut"))).select("label", *METRIC_ORDER, *CELLS)


def confusion_pct(cells: DataFrame) -> DataFrame:
    """Confusion cells as rows (actual, predicted, n, pct of the actual class)."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n"),
                    (100 * F.try_divide(F.col(c).cast("double"), F.col(u) + F.col(v))).alias("pct"),
                )
                for a, b, c, u, v in (
                    (0, 0, "tn", "tn", "fp"), (0, 1, "fp", "tn", "fp"),
                    (1, 0, "fn", "fn", "tp"), (1, 1, "tp", "fn", "tp"),
                )
            ]
        )
    )
    return cells.select(rows.alias("_r")).select("_r.*")


# -- thresholds --------------------------------------------------------------------------


def _sweep(counts: DataFrame, thresholds: Sequence[float], p: str) -> DataFrame:
    """tn, fp, fn, tp at each threshold from rows (p, pos, neg), by one aggregation per grid cell."""
    grid = sorted({float(t) for t in thresholds})
    placed = with_bucket(counts.select(F.col(p).cast("double").alias("_p"), "pos", "neg"), "_p", grid, "_cell")
    cells = placed.groupBy("_cell").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # From here on at most len(grid) + 1 rows. Cell i holds the scores with i thresholds
    # at or below them; an empty cell still needs a row for its threshold.
    points = counts.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate([None, *grid])], "_cell int, threshold double"
    )
    per_cell = points.join(cells, ["_cell"], "left").na.fill(0, ["_pos", "_neg"])
    everything = Window.partitionBy(F.lit(0))
    at_or_above = everything.orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tp, fp = F.sum("_pos").over(at_or_above), F.sum("_neg").over(at_or_above)
    return (
        per_cell.select(
            "threshold",
            (F.sum("_neg").over(everything) - fp).alias("tn"),
            fp.alias("fp"),
            (F.sum("_pos").over(everything) - tp).alias("fn"),
            tp.alias("tp"),
        )
        .where(F.col("threshold").isNotNull())
    )


def _as_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    pos, neg = _classes(y)
    return checked(df, y, p).select(p, pos.alias("pos"), neg.alias("neg"))


def sweep(df: DataFrame, thresholds: Sequence[float], y: str = "y", p: str = "p") -> DataFrame:
    """tn, fp, fn, tp at each threshold, from one pass that only counts rows per grid cell."""
    return _sweep(_as_counts(df, y, p), thresholds, p)


def threshold_grid(totals: DataFrame, p: str = "p", steps: Sequence[float] = GRID_STEPS) -> list[float]:
    """Distinct quantiles of the scores, linearly interpolated, at most one per step.

    ``totals`` are distinct scores with running counts: each knows which ranks it holds.
    """
    upto, here = F.col("pos_upto") + F.col("neg_upto"), F.col("pos") + F.col("neg")
    position = lambda q: (F.col("pos_all") + F.col("neg_all") - 1).cast("double") * q
    both_sides = F.flatten(
        F.transform(
            F.array(*[F.lit(float(q)) for q in steps]),
            lambda q: F.array(
                F.struct(q.alias("prob"), position(q).alias("pos"), F.floor(position(q)).alias("place")),
                F.struct(q.alias("prob"), position(q).alias("pos"), F.ceil(position(q)).alias("place")),
            ),
        )
    )
    mine = F.filter(both_sides, lambda w: (w["place"] < upto) & (w["place"] >= upto - here))
    wanted = totals.select(F.col(p).cast("double").alias("_v"), F.explode(mine).alias("_w")).select("_v", "_w.*")
    low = F.max(F.when(F.col("place") == F.floor("pos"), F.col("_v")))
    high = F.max(F.when(F.col("place") == F.ceil("pos"), F.col("_v")))
    share = F.first("pos") - F.floor(F.first("pos"))
    cuts = wanted.groupBy("prob").agg((low + share * (high - low)).alias("quantile"))
    return sorted({r["quantile"] for r in cuts.collect()})  # one row per step


def best_threshold_f1(
    df: DataFrame, target: str = "positive", y: str = "y", p: str = "p",
    steps: Sequence[float] = GRID_STEPS,
) -> DataFrame:
    """One row (threshold, f1): greatest F1 of the positive or the risk class, lowest cut on ties."""
    if target not in ("positive", "risk"):
        raise ValueError(f"unknown target class: {target}")
    name = "f1" if target == "positive" else "f1_risk"
    totals = distinct_scores(df, y, p)
    scored = with_rates(_sweep(totals, threshold_grid(totals, p, steps), p))
    best = scored.orderBy(F.desc(name), "threshold").limit(1)
    return best.select("threshold", F.col(name).alias("f1"))


def best_threshold_cost(
    df: DataFrame, cost_miss: float = COST_MISS, cost_alarm: float = COST_ALARM,
    y: str = "y", p: str = "p", steps: Sequence[float] = GRID_STEPS,
) -> DataFrame:
    """One row (threshold, cost): least mean cost of missed risks and false alarms."""
    if cost_miss <= 0 or cost_alarm <= 0:
        raise ValueError("costs must be positive")
    totals = distinct_scores(df, y, p)
    cells = _sweep(totals, threshold_grid(totals, p, steps), p)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cost = (F.lit(float(cost_miss)) * F.col("fp") + F.lit(float(cost_alarm)) * F.col("fn")) / n
    return cells.select("threshold", cost.alias("cost")).orderBy("cost", "threshold").limit(1)


def operating_points(df: DataFrame, thresholds: Sequence[float], y: str = "y", p: str = "p") -> DataFrame:
    """Confusion and rates per threshold, with the number flagged as at risk."""
    return with_rates(sweep(df, thresholds, y, p)).withColumn("flagged", F.col("tn") + F.col("fn"))


# -- calibration -------------------------------------------------------------------------


def calibration_table(
    df: DataFrame, bins: int = 10, strategy: str = "quantile", y: str = "y", p: str = "p"
) -> DataFrame:
    """Per score bin: n, mean score, observed rate, score bounds, and their difference.

    Bins end at distinct score quantiles, or at equal steps over [0, 1].
    """
    steps = np.linspace(0.0, 1.0, bins + 1)
    if strategy == "uniform":
        counts, edges = _as_counts(df, y, p), [float(e) for e in steps[1:-1]]
    elif strategy == "quantile":
        counts = distinct_scores(df, y, p)
        edges = threshold_grid(counts, p, [float(q) for q in steps])[1:-1]
    else:
        raise ValueError("strategy must be 'quantile' or 'uniform'")
    binned = with_bucket(counts.select(F.col(p).cast("double").alias("_p"), "pos", "neg"), "_p", edges, "bin")
    n = F.col("pos") + F.col("neg")
    table = binned.groupBy("bin").agg(
        F.sum(n).alias("n"), (F.sum(n * F.col("_p")) / F.sum(n)).alias("mean_p"),
        (F.sum("pos").cast("double") / F.sum(n)).alias("observed"),
        F.min("_p").alias("min_p"), F.max("_p").alias("max_p"),
    )
    return table.withColumn("error", F.col("observed") - F.col("mean_p"))


def calibration_error(df: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """One row (ece): mean absolute bin error weighted by bin size."""
    table = calibration_table(df, bins, "quantile", y, p)
    return table.agg((F.sum(F.col("n") * F.abs("error")) / F.sum("n")).alias("ece"))


# -- reports -----------------------------------------------------------------------------


def cv_report(
    oof: DataFrame, y: str = "y", p: str = "p", fold: str = "fold", by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by, metric, mean, sd) over folds of out-of-fold scores; sd is the population one."""
    folds = evaluate(oof, 0.5, y, p, [*by, fold])
    long = folds.unpivot([*by, fold], CV_METRICS, "metric", "value")
    return long.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    )


def metrics_long(metrics: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Metric table in long form (ids, metric, value), metrics in canonical order first."""
    ordered = [c for c in METRIC_ORDER if c in metrics.columns]
    rest = [c for c in metrics.columns if c not in ordered and c not in ids]
    wide = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in ordered + rest])
    return wide.unpivot(list(ids), ordered + rest, "metric", "value")
