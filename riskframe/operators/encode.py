"""Preprocessing fitted on training rows only and applied as plain column expressions.

The fitted state is a few numbers per column: median, mean, spread, and the list of kept
categories. It becomes Spark ML stages, so a fitted pipeline is an ordinary PipelineModel that saves,
loads and scores without Python. A column with few categories is one expression for each; one with many is
a label index and a sparse one-hot vector, so neither plan nor row grows with the vocabulary. There is no limit on
categories but the one of any fitted model: it keeps each by name, and a linear one a coefficient for it, on the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.ordered import column_quantiles

INFREQUENT = "infrequent"
# A fitted column with more values is looked up in a table of labels; fewer are compared in the plan itself. The result is the same.
LISTED = 200


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, median), exact; a column without any value has no row."""
    return column_quantiles(df, columns, [0.5]).select("feature", F.col("quantile").alias("median"))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs replaced by the column's median. Columns that are all NULL are dropped."""
    found = {r["feature"]: r["median"] for r in medians(df, columns).collect()}
    fixed = {c: F.coalesce(F.col(c).cast("double"), F.lit(found[c])) for c in columns if c in found}
    return df.withColumns(fixed).drop(*[c for c in columns if c not in found])


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, value, n) over the values, as text, of several columns, NULL included."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "feature", "value")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, value, n) over the non-NULL values, as text, of several columns."""
    return _value_counts(df, columns).where(F.col("value").isNotNull())


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, mode, n): the most frequent value, the smallest on ties."""
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return category_counts(df, columns).groupBy("feature").agg(best.alias("mode"), F.max("n").alias("n"))


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs replaced by the column's most frequent value, as text."""
    found = {r["feature"]: r["mode"] for r in modes(df, columns).collect()}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(found.get(c))) for c in columns}
    )


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, mean, sd) with the population sd; one aggregate row is turned upright."""
    pair = lambda c: F.struct(
        F.lit(c).alias("feature"), F.avg(F.col(c).cast("double")).alias("mean"),
        F.stddev_pop(F.col(c).cast("double")).alias("sd"),
    )
    wide = df.agg(F.array(*[pair(c) for c in columns]).alias("_all"))
    return wide.select(F.inline("_all"))


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns minus mean over population sd; a constant column becomes 0."""
    found = {r["feature"]: r for r in moments(df, columns).collect()}
    scaled = {}
    for c in columns:
        mean, sd = found[c]["mean"], found[c]["sd"]
        scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(sd or 1.0)
    return df.withColumns(scaled)


def one_hot_vocabulary(df: DataFrame, columns: Sequence[str], min_frequency: int = 20) -> DataFrame:
    """Rows (feature, category, n): categories kept, rarer ones pooled as one."""
    counts = category_counts(df, columns)
    kept = F.when(F.col("n") >= min_frequency, F.col("value")).otherwise(INFREQUENT)
    return counts.withColumn("category", kept).groupBy("feature", "category").agg(F.sum("n").alias("n"))


@dataclass
class FittedEncoder:
    """Fitted numbers of the preprocessing, and the stages that apply them."""

    numeric: list[str]
    log_scaled: list[str]
    categorical: list[str]
    medians: dict[str, float]
    centers: dict[str, tuple[float, float]]
    fills: dict[str, str]
    kept: dict[str, list[str]]
    rare: dict[str, list[str]] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        """Names after encoding: numeric names, then ``column_value``."""
        names = list(self.numeric)
        for c in self.categorical:
            names += [f"{c}_{v}" for v in self.kept[c]]
            if self.rare[c]:
                names.append(f"{c}_{INFREQUENT}")
        return names

    def _numeric_sql(self, c: str) -> str:
        x = f"coalesce(nanvl(cast(`{c}` as double), cast(null as double)), {self.medians[c]!r}D)"
        if c in self.log_scaled:
            x = f"signum({x}) * log1p(abs({x}))"
        if c in self.centers:
            mean, sd = self.centers[c]
            x = f"(({x}) - ({mean!r}D)) / {sd!r}D"
        return x

    def _filled_sql(self, c: str) -> str:
        return f"coalesce(cast(`{c}` as string), {_quoted(self.fills[c])})"

    def _category_sql(self, c: str) -> list[str]:
        value = self._filled_sql(c)
        out = [f"cast({value} = {_quoted(v)} as double)" for v in self.kept[c]]
        if self.rare[c]:
            listed = ", ".join(_quoted(v) for v in self.rare[c])
            out.append(f"cast({value} in ({listed}) as double)")
        return out

    def expressions(self) -> list[str]:
        """One SQL expression per encoded feature, in the order of the names."""
        return [self._numeric_sql(c) for c in self.numeric] + [e for c in self.categorical for e in self._category_sql(c)]

    def is_wide(self, c: str) -> bool:
        return len(self.kept[c]) + len(self.rare[c]) > LISTED

    def _wide_stages(self, c: str, at: int, out: str) -> list:
        """Label index (kept ones first), rare labels as one slot, and a sparse vector; an unknown value is the slot that is dropped."""
        kept, rare = len(self.kept[c]), len(self.rare[c])
        slots = kept + bool(rare)
        index = StringIndexerModel.from_labels([*self.kept[c], *self.rare[c]], f"_w{at}", f"_x{at}", handleInvalid="keep")
        slot = f"case when _x{at} < {kept} then _x{at} when _x{at} < {kept + rare} then {kept}D else {slots}D end"
        # The encoder learns its size from one row, the largest slot.
        largest = SparkSession.active().createDataFrame([(float(slots),)], f"_s{at} double")
        vectors = OneHotEncoder(inputCols=[f"_s{at}"], outputCols=[out], dropLast=True).fit(largest)
        return [
            SQLTransformer(statement=f"SELECT *, {self._filled_sql(c)} AS _w{at} FROM __THIS__"), index,
            SQLTransformer(statement=f"SELECT *, {slot} AS _s{at} FROM __THIS__"), vectors,
        ]

    def stages(self, features: str = "features") -> list:
        """Stages adding the feature vector."""
        inner, plain, wide, at = [], [], [], 0

        def add(name: str, sql: str) -> None:
            inner.append(f"_f{len(inner)}:{_safe(name)}")
            plain.append(f"{sql} AS `{inner[-1]}`")

        for c in self.numeric:
            add(c, self._numeric_sql(c))
        for c in self.categorical:
            if self.is_wide(c):
                inner.append(f"_v{at}{'r' if self.rare[c] else 'k'}:{_safe(c)}")
                wide += self._wide_stages(c, at, inner[-1])
                at += 1
            else:
                names = [f"{c}_{v}" for v in self.kept[c]] + [f"{c}_{INFREQUENT}"] * bool(self.rare[c])
                for name, sql in zip(names, self._category_sql(c)):
                    add(name, sql)
        selected = "".join(f", {e}" for e in plain)
        return [SQLTransformer(statement=f"SELECT *{selected} FROM __THIS__"), *wide, VectorAssembler(inputCols=inner, outputCol=features)]

    def unscaled(self) -> FittedEncoder:
        """The same fit without the scaling step."""
        return replace(self, centers={})

    def model(self, features: str = "features") -> PipelineModel:
        return PipelineModel(self.stages(features))

    def columns(self, df: DataFrame, ids: Sequence[str]) -> DataFrame:
        """Encoded features as plain columns beside the ids."""
        return df.selectExpr(*ids, *[f"{e} AS `{n}`" for e, n in zip(self.expressions(), self.feature_names())])


def _wide_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Names of the slots of each sparse column."""
    labels = {s.getOutputCol(): s.labels for s in model.stages if isinstance(s, StringIndexerModel)}
    found = {}
    for s in model.stages:
        if isinstance(s, OneHotEncoderModel):
            out, size = s.getOutputCols()[0], s.categorySizes[0] - 1
            place, column = out.split(":", 1)
            names = labels["_x" + place[2:-1]]
            found[out] = [_safe(f"{column}_{v}") for v in (names[: size - 1] + [INFREQUENT] if place.endswith("r") else names[:size])]
    return found


def encoded_names(model: PipelineModel) -> list[str]:
    """Names of the encoded features of a fitted or loaded pipeline, in the order of its feature vector."""
    assembler, wide = next(s for s in model.stages if isinstance(s, VectorAssembler)), _wide_labels(model)
    return [n for c in assembler.getInputCols() for n in wide.get(c, [c.split(":", 1)[1]])]


def encoded_columns(model: PipelineModel, df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The pipeline's encoded features as plain columns beside the ids, under positions ``_0``, ``_1``, ..."""
    at = next(i for i, s in enumerate(model.stages) if isinstance(s, VectorAssembler))
    wide, columns = _wide_labels(model), []
    for c in model.stages[at].getInputCols():
        columns += [vector_to_array(F.col(f"`{c}`"))[i] for i in range(len(wide[c]))] if c in wide else [F.col(f"`{c}`")]
    out = PipelineModel(model.stages[:at]).transform(df)
    return out.select(*ids, *[c.alias(f"_{i}") for i, c in enumerate(columns)])


def _safe(name: str) -> str:
    """Names travel with a saved pipeline; a dot or backtick in one would break its columns."""
    return re.sub("[.`]", "_", name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_encoder(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    log_scaled: Sequence[str] = (),
    scale: bool = True,
    min_frequency: int = 20,
) -> FittedEncoder:
    """Learn medians, scale and categories from ``df``.

    Numeric columns without any value are left out; so are categorical ones.
    """
    middle = {}
    if numeric:
        middle = {r["feature"]: r["median"] for r in medians(df, numeric).collect()}
    numeric = [c for c in numeric if c in middle]
    log_scaled = [c for c in log_scaled if c in numeric]
    encoder = FittedEncoder(numeric, log_scaled, [], middle, {}, {}, {}, {})
    if scale and numeric:
        filled = df.selectExpr(*[f"{encoder._numeric_sql(c)} AS `{c}`" for c in numeric])
        found = {r["feature"]: r for r in moments(filled, numeric).collect()}
        encoder.centers = {c: (found[c]["mean"], found[c]["sd"] or 1.0) for c in numeric}
    if categorical:
        _fit_categories(df, categorical, min_frequency, encoder)
    return encoder


def _fit_categories(df: DataFrame, columns: Sequence[str], min_frequency: int, encoder: FittedEncoder) -> None:
    """Fill value, kept and pooled categories. Filled rows count towards the mode."""
    found: dict[str, dict] = {c: {} for c in columns}
    for r in _value_counts(df, columns).collect():
        found[r["feature"]][r["value"]] = r["n"]
    for c in columns:
        n = found[c]
        missing = n.pop(None, 0)
        if not n:
            continue
        fill = min(n, key=lambda v: (-n[v], v))
        n[fill] += missing
        encoder.categorical.append(c)
        encoder.fills[c] = fill
        encoder.kept[c] = sorted(v for v in n if n[v] >= min_frequency)
        encoder.rare[c] = sorted(v for v in n if n[v] < min_frequency)


class TabularEncoder(Estimator):
    """Estimator form of ``fit_encoder``, so that each fold fits its own preprocessing."""

    @keyword_only
    def __init__(self, *, numeric=(), categorical=(), log_scaled=(), scale=True, min_frequency=20, features="features"):
        super().__init__()
        self.settings = dict(
            numeric=list(numeric), categorical=list(categorical), log_scaled=list(log_scaled),
            scale=scale, min_frequency=min_frequency,
        )
        self.features = features

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return self.fit_state(dataset).model(self.features)

    def fit_state(self, dataset: DataFrame) -> FittedEncoder:
        """The fitted numbers in place of a model."""
        return fit_encoder(dataset, **self.settings)


def matrix_long(df: DataFrame, key: str, encoder: FittedEncoder) -> DataFrame:
    """Encoded matrix as rows (key, feature, value)."""
    return encoder.columns(df, [key]).unpivot([key], encoder.feature_names(), "feature", "value")


def encoder_to_json(encoder: FittedEncoder) -> str:
    """Fitted numbers as JSON, to keep beside a saved model."""
    return json.dumps(asdict(encoder), ensure_ascii=False)


def encoder_from_json(text: str) -> FittedEncoder:
    state = json.loads(text)
    state["centers"] = {c: tuple(v) for c, v in state["centers"].items()}
    return FittedEncoder(**state)
