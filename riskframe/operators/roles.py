"""Column roles: which columns may be features, and the guard against target leakage."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that must never be features.
# Unit-level columns that encode the outcome or the presence filter.
LEAKED_UNIT_COLUMNS = [
    "VL_PROFICIENCIA_LP", "VL_PESO_ALUNO_LP", "CO_CADERNO_LP",
    "CO_BLOCO_1", "CO_BLOCO_2", "CO_BLOCO_3", "CO_BLOCO_4",
    "TX_RESPOSTA_BLOCO_1", "TX_RESPOSTA_BLOCO_2", "TX_RESPOSTA_BLOCO_3", "TX_RESPOSTA_BLOCO_4",
    "TX_GABARITO_BLOCO_1", "TX_GABARITO_BLOCO_2", "TX_GABARITO_BLOCO_3", "TX_GABARITO_BLOCO_4",
    "IN_PREENCHIMENTO_LP", "IN_PRESENCA_LP",
]
# Entity-level columns measured in the target year.
LEAKED_DATED_COLUMNS = [
    "pc_alfabetizado_aeeb_2025", "vl_media_lp",
    "pc_nivel_0", "pc_nivel_1", "pc_nivel_2", "pc_nivel_3", "pc_nivel_4",
    "pc_nivel_5", "pc_nivel_6", "pc_nivel_7", "pc_nivel_8",
    "pc_alfabetizado_metas_2025", "gap_meta_2025", "atingiu_meta_2025",
    "evolucao_2023_2025", "pc_participacao", "co_nivel_alfabetizacao",
]
# Identifiers and names.
ID_COLUMNS = [
    "ID_ALUNO", "ID_ESCOLA", "id_aluno", "id_escola",
    "co_municipio", "no_municipio", "NO_MUNICIPIO", "nu_ano_avaliacao", "id_municipio",
]
# Columns encoded as categories, kept as description only, or log-scaled.
CATEGORICAL_COLUMNS = ["sg_uf", "regiao", "porte", "capital_uf", "tp_dependencia"]
DESCRIPTIVE_COLUMNS = ["nome_regiao_imediata", "nome_regiao_intermediaria"]
LOG_COLUMNS = [
    "populacao_2024", "total_mat_fund_ai", "total_mat_1_2_ano", "qtd_escolas",
    "qtd_escolas_municipais", "qtd_escolas_estaduais", "qtd_escolas_privadas",
    "qtd_escolas_urbanas", "qtd_escolas_rurais", "total_doc_fund_ai",
    "total_tur_fund_ai", "pib", "va", "va_agropecuaria", "va_industria", "va_servicos",
]


class LeakageError(AssertionError):
    """A forbidden column is present."""


@dataclass(frozen=True)
class Roles:
    """Names by role. The defaults are the names of the original tables."""

    forbidden: Collection[str] = field(
        default_factory=lambda: frozenset(LEAKED_UNIT_COLUMNS + LEAKED_DATED_COLUMNS + ID_COLUMNS)
    )
    categorical: Sequence[str] = tuple(CATEGORICAL_COLUMNS)
    descriptive: Sequence[str] = tuple(DESCRIPTIVE_COLUMNS)
    log_scaled: Sequence[str] = tuple(LOG_COLUMNS)

    def assert_no_leakage(self, columns: Iterable[str], allow: Iterable[str] = ()) -> None:
        """Raise LeakageError if a forbidden name is among ``columns`` and not allowed."""
        found = sorted(set(columns).intersection(self.forbidden).difference(allow))
        if found:
            raise LeakageError(f"forbidden columns present: {found}")

    def feature_columns(
        self, df: DataFrame, target: str | None = None, extra_drop: Iterable[str] = ()
    ) -> tuple[list[str], list[str]]:
        """(numeric, categorical) feature names from the schema alone.

        Forbidden, descriptive and dropped names are left out. A remaining column that is
        neither listed as categorical nor numeric or boolean raises TypeError.
        """
        skip = {*self.forbidden, *self.descriptive, *extra_drop, target}
        numeric, categorical, stray = [], [], []
        for f in df.schema.fields:
            if f.name in skip:
                continue
            if f.name in self.categorical:
                categorical.append(f.name)
            elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                numeric.append(f.name)
            else:
                stray.append(f.name)
        if stray:
            raise TypeError(f"columns neither numeric nor listed as categorical: {stray}")
        return numeric, categorical


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def drop_dated(
    df: DataFrame, prefixes: Sequence[str], names: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Drop columns listed or beginning with a prefix, but for those to keep."""
    gone = [
        c for c in df.columns if c not in keep and (c in names or c.startswith(tuple(prefixes)))
    ]
    return df.drop(*gone)


def split_targets(
    df: DataFrame, key: str, targets: Sequence[str], dated: Sequence[str], roles: Roles,
    allow: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(features, targets) as two tables; features pass the leakage guard."""
    features = df.drop(*[c for c in {*targets, *dated} if c in df.columns])
    roles.assert_no_leakage(features.columns, allow=[key, *allow])
    return features, df.select(key, *targets)


def leakage_scan(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Columns that separate the two classes by a cut: rows (feature, bounds, separates)."""
    def bounds_of(c: str):
        x = F.col(c).cast("double")
        neg, pos = F.when(F.col(label) == 0, x), F.when(F.col(label) == 1, x)
        return F.struct(
            F.lit(c).alias("feature"), F.min(neg).alias("min_neg"), F.max(neg).alias("max_neg"),
            F.min(pos).alias("min_pos"), F.max(pos).alias("max_pos"),
        )

    # One aggregate row for all columns, turned upright.
    wide = df.agg(F.array(*[bounds_of(c) for c in columns]).alias("_all"))
    bounds = wide.select(F.inline("_all"))
    separates = (F.col("max_neg") <= F.col("min_pos")) | (F.col("max_pos") <= F.col("min_neg"))
    return bounds.withColumn("separates", F.coalesce(separates, F.lit(False)))


def leakage_evidence(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per class: rows, least and greatest score, and whether the score decides the class.

    The score decides it when the lower class ends at or below the start of the upper one.
    """
    stats = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.min(score).alias("min_score"), F.max(score).alias("max_score")
    )
    both = Window.partitionBy(F.lit(0))  # one row per class
    neg_max = F.max(F.when(F.col(label) == 0, F.col("max_score"))).over(both)
    pos_min = F.min(F.when(F.col(label) == 1, F.col("min_score"))).over(both)
    return stats.withColumn("separates", F.coalesce(neg_max <= pos_min, F.lit(False)))
