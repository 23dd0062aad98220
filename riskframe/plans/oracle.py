"""DuckDB SQL for the registered queries, written against the raw test tables.

``select`` wraps a body so that doubles are shifted by 1e-9 and rounded to 6 places and
integers widened, as the registered queries do. A column spec reads ``name:kind`` with kind d, i, s or b.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from riskframe.operators.evaluate import CV_METRICS, GRID_STEPS, METRIC_ORDER
from riskframe.plans.queries import (
    HOLDOUT_CUTS, IMPORTANCE_WEIGHTS, OPERATING_CUTS, SHAP_WEIGHTS,
)

CASTS = {
    "d": 'round(CAST("{c}" AS DOUBLE) + 1e-9, 6) + 0e0 AS "{c}"',
    "i": 'CAST("{c}" AS BIGINT) AS "{c}"',
    "s": 'CAST("{c}" AS VARCHAR) AS "{c}"',
    "b": 'CAST("{c}" AS BOOLEAN) AS "{c}"',
}

# Shared pieces; each may use the ones before it.
PARTS = {
    "u": """SELECT o_orderkey AS unit_id, o_custkey AS entity_id, o_orderpriority AS network,
            o_orderstatus AS status, o_totalprice AS raw_score, CAST(o_totalprice >= 250000 AS INT) AS label,
            year(o_orderdate) AS yr FROM orders""",
    "pu": "SELECT * FROM u WHERE status <> 'P' AND raw_score IS NOT NULL",
    "scored": """SELECT unit_id, entity_id, network, label AS y,
            floor((5e-1 * least(raw_score / 5e5, 1e0)
                   + 5e-1 * (CAST(concat('0x', substr(md5(CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000)::DOUBLE / 1e3)
                  * 1e3 + 5e-1) / 1e3 AS p FROM pu""",
    "yearly": """SELECT entity_id, yr, 100 * avg(CASE WHEN status <> 'P' THEN label::DOUBLE END) AS outcome,
            sum((status <> 'P')::INT) AS n_present, count(*) AS n_sites, sum((status = 'F')::INT) AS n_rural,
            sum((network = '1-URGENT')::INT) AS n_private, sum(raw_score) AS output,
            sum(CASE WHEN network = '1-URGENT' THEN raw_score END) AS va_agro,
            sum(CASE WHEN network = '2-HIGH' THEN raw_score END) AS va_industry
            FROM u GROUP BY entity_id, yr""",
    "grp": """SELECT n_nationkey AS group_code, n_name AS group_name, r_name AS region_name
            FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "hist": """SELECT entity_id, max(CASE WHEN yr = 1998 THEN outcome END) AS outcome_1998,
            max(CASE WHEN yr = 1999 THEN outcome END) AS outcome_1999, max(CASE WHEN yr = 2000 THEN outcome END) AS outcome_2000,
            sum(CASE WHEN yr <= 1999 THEN n_sites END) AS n_sites, sum(CASE WHEN yr <= 1999 THEN n_rural END) AS n_sites_rural,
            sum(CASE WHEN yr <= 1999 THEN n_private END) AS n_sites_private,
            sum(CASE WHEN yr = 2000 THEN n_present END) AS units_2000 FROM yearly GROUP BY entity_id""",
    "gold": """SELECT *, outcome_2000 - goal_2000 AS gap_2000, CAST(outcome_2000 >= goal_2000 AS INT) AS reached_2000 FROM (
            SELECT c_custkey AS entity_id, c_name AS entity_name, c_nationkey AS group_code, c_mktsegment AS segment,
            hist.* EXCLUDE (entity_id),
            (45 + c_custkey % 11 + 2)::DOUBLE AS goal_1999, (45 + c_custkey % 11 + 4)::DOUBLE AS goal_2000,
            (45 + c_custkey % 11 + 6)::DOUBLE AS goal_2001, (45 + c_custkey % 11 + 8)::DOUBLE AS goal_2002,
            (45 + c_custkey % 11 + 10)::DOUBLE AS goal_2003
            FROM customer LEFT JOIN hist ON hist.entity_id = c_custkey)""",
    "size": """SELECT o_custkey AS entity_id, sum(l_quantity) AS items, count(*) AS lines, sum(l_quantity) * 1000 AS population
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE year(o_orderdate) = 1999 GROUP BY o_custkey""",
    "ext": """SELECT k.entity_id, items, lines, population, a.output, s.output AS va, s.va_agro, s.va_industry,
            s.output - coalesce(s.va_agro, 0e0) - coalesce(s.va_industry, 0e0) AS va_services,
            c_acctbal AS balance, CAST(c_mktsegment = 'BUILDING' AS INT) AS hub, group_name, region_name
            FROM (SELECT DISTINCT c_custkey AS entity_id FROM customer) k
            LEFT JOIN size USING (entity_id)
            LEFT JOIN (SELECT * FROM yearly WHERE yr = 1999) a ON a.entity_id = k.entity_id
            LEFT JOIN (SELECT * FROM yearly WHERE yr = 1998) s ON s.entity_id = k.entity_id
            LEFT JOIN customer ON c_custkey = k.entity_id
            LEFT JOIN grp ON group_code = c_nationkey""",
    "store": """SELECT gold.*, ext.* EXCLUDE (entity_id),
            outcome_1999 - outcome_1998 AS delta_1998_1999, outcome_1999 - goal_1999 AS gap_1999,
            CAST(outcome_1999 >= goal_1999 AS DOUBLE) AS reached_1999, goal_2000 - outcome_1999 AS effort_2000,
            goal_2003 - outcome_1999 AS ambition_2003,
            n_sites_rural / nullif(n_sites, 0) AS share_rural, n_sites_private / nullif(n_sites, 0) AS share_private,
            items / nullif(lines, 0) AS items_per_line, output / nullif(population, 0) AS output_per_capita,
            va_agro / nullif(va, 0) AS share_agro, ln(1 + population) AS log_population,
            CASE WHEN population <= 0 THEN NULL WHEN population <= 5000 THEN 'pequeno_1' WHEN population <= 20000 THEN 'pequeno_2'
                 WHEN population <= 100000 THEN 'medio' WHEN population <= 500000 THEN 'grande'
                 WHEN population IS NOT NULL THEN 'metropole' END AS size_band
            FROM gold JOIN ext ON gold.entity_id = ext.entity_id""",
    "m2000": """SELECT *, outcome_1999 AS outcome_t1, outcome_1998 AS outcome_t2, delta_1998_1999 AS delta_t1, goal_2000 AS goal_t,
            effort_2000 AS effort_t, reached_1999 AS reached_t1 FROM store""",
    "m2001": """SELECT *, outcome_2000 AS outcome_t1, outcome_1999 AS outcome_t2, outcome_2000 - outcome_1999 AS delta_t1,
            goal_2001 AS goal_t, goal_2001 - outcome_2000 AS effort_t, reached_2000::DOUBLE AS reached_t1 FROM store""",
    "projected": """SELECT entity_id, entity_name, group_name,
            floor((5e-1 * (least(greatest(coalesce(effort_t, 5e1), 0e0), 1e2) / 1e2)
                   + 5e-1 * (CAST(concat('0x', substr(md5(CAST(entity_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000)::DOUBLE / 1e3)
                  * 1e3 + 5e-1) / 1e3 AS risk,
            goal_t AS goal, outcome_t1 AS last_outcome, effort_t AS effort, CAST(reached_t1 AS INT) AS reached_last FROM m2001""",
    "folds": """SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5(concat('42:', CAST(unit_id AS VARCHAR))), unit_id) - 1) % 5 AS fold FROM scored""",
    "oof": """SELECT unit_id, fold, y, 'dummy' AS candidate, 1e0 AS p FROM folds
            UNION ALL SELECT unit_id, fold, y, 'mixed', p FROM folds
            UNION ALL SELECT unit_id, fold, y, 'noisy',
            (CAST(concat('0x', substr(md5(concat('n', CAST(unit_id AS VARCHAR))), 1, 8)) AS BIGINT) % 1000)::DOUBLE / 1e3 FROM folds""",
}
NEEDS = {
    "pu": ["u"], "scored": ["pu"], "yearly": ["u"], "hist": ["yearly"], "gold": ["hist"],
    "ext": ["size", "yearly", "grp"], "store": ["gold", "ext"], "m2000": ["store"], "m2001": ["store"],
    "projected": ["m2001"], "folds": ["scored"], "oof": ["folds"],
}


def _order(parts: list[str]) -> list[str]:
    out: list[str] = []

    def add(p: str) -> None:
        for q in NEEDS.get(p, []):
            add(q)
        if p not in out:
            out.append(p)

    for p in parts:
        add(p)
    return out


def select(spec: str, body: str, parts: str = "", **more: str) -> str:
    """Full query: shared parts, further named parts, and the body with its columns cast."""
    columns = ", ".join(CASTS[k].format(c=c) for c, k in (x.split(":") for x in spec.split()))
    return with_parts(f"SELECT {columns} FROM ({body}) AS result", parts, **more)


def with_parts(body: str, parts: str = "", **more: str) -> str:
    """The body after the shared parts it reads and further named ones."""
    ctes = [f"{p} AS ({PARTS[p]})" for p in _order(parts.split())]
    ctes += [f"{name} AS ({text})" for name, text in more.items()]
    head = f"WITH {', '.join(ctes)} " if ctes else ""
    return head + body


def array(values) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


# -- metric pieces -----------------------------------------------------------------------

RATES = """2e0 * tp / nullif(2 * tp + fp + fn, 0) AS f1_, 2e0 * tn / nullif(2 * tn + fp + fn, 0) AS f1r_,
    tp / nullif(tp + fn, 0)::DOUBLE AS rec_, tn / nullif(tn + fp, 0)::DOUBLE AS recr_,
    tp / nullif(tp + fp, 0)::DOUBLE AS prec_, tn / nullif(tn + fn, 0)::DOUBLE AS precr_"""
NAMED_RATES = """coalesce(f1_, 0e0) AS f1, coalesce(f1r_, 0e0) AS f1_risk,
    coalesce((rec_ + recr_) / 2, rec_, recr_) AS balanced_accuracy, (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS accuracy,
    coalesce(prec_, 0e0) AS "precision", coalesce(rec_, 0e0) AS recall,
    coalesce(precr_, 0e0) AS precision_risk, coalesce(recr_, 0e0) AS recall_risk"""


def cells(source: str, by: str, cut: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}{cut} AS threshold, count(*) AS n, avg(y::DOUBLE) AS prevalence,
        sum((y = 0 AND p < {cut})::INT) AS tn, sum((y = 0 AND p >= {cut})::INT) AS fp,
        sum((y = 1 AND p < {cut})::INT) AS fn, sum((y = 1 AND p >= {cut})::INT) AS tp,
        avg((p - y) * (p - y)) AS brier,
        avg(CASE WHEN y = 1 THEN -ln(greatest(1e-15, least(1e0 - 1e-15, p)))
                 ELSE -ln(1e0 - greatest(1e-15, least(1e0 - 1e-15, p))) END) AS log_loss
        FROM {source} {group}"""


def totals(source: str, by: str = "") -> str:
    """Distinct scores with class counts and what lies above and below."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT *, sum(pos) OVER (w) AS pos_upto, sum(neg) OVER (w) AS neg_upto,
        sum(pos) OVER ({part}) AS pos_all, sum(neg) OVER ({part}) AS neg_all FROM (
        SELECT {keys}p, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY {keys}p)
        WINDOW w AS ({part} ORDER BY p)"""


def ranking(source: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {keys}
        sum(neg::DOUBLE * (pos_all - pos_upto + pos / 2e0)) / nullif(max(pos_all)::DOUBLE * max(neg_all), 0) AS roc_auc,
        sum(pos / pos_all::DOUBLE * (pos_all - pos_upto + pos) / (pos_all - pos_upto + pos + neg_all - neg_upto + neg)) AS pr_auc,
        sum(neg / neg_all::DOUBLE * neg_upto / (neg_upto + pos_upto)) AS pr_auc_risk
        FROM ({totals(source, by)}) {group}"""


def evaluated(source: str, by: str, cut: str) -> str:
    joined = f"JOIN ({ranking(source, by)}) r USING ({by})" if by else f"CROSS JOIN ({ranking(source, by)}) r"
    return f"""SELECT *, fp AS miss_risk, fn AS false_alarm, {NAMED_RATES}
        FROM (SELECT *, {RATES} FROM ({cells(source, by, cut)}) c {joined})"""


METRIC_SPEC = " ".join(f"{m}:d" for m in METRIC_ORDER)
CELL_SPEC = "threshold:d n:i prevalence:d tn:i fp:i fn:i tp:i miss_risk:i false_alarm:i"

GRID = f"SELECT DISTINCT unnest(quantile_cont(p, {array(GRID_STEPS)})) AS threshold FROM scored"
SWEEP = """SELECT threshold, sum((y = 0 AND p < threshold)::INT) AS tn, sum((y = 0 AND p >= threshold)::INT) AS fp,
    sum((y = 1 AND p < threshold)::INT) AS fn, sum((y = 1 AND p >= threshold)::INT) AS tp
    FROM grid CROSS JOIN (SELECT p, y FROM scored) GROUP BY threshold"""


def calibration(edges: str) -> str:
    return f"""SELECT bin, count(*) AS n, avg(p) AS mean_p, avg(y::DOUBLE) AS observed, min(p) AS min_p, max(p) AS max_p,
        avg(y::DOUBLE) - avg(p) AS error
        FROM (SELECT p, y, (SELECT count(*) FROM ({edges}) e WHERE e.edge <= p) AS bin FROM scored) GROUP BY bin"""


TENTHS = [float(q) for q in np.linspace(0, 1, 11)]
DECILES = f"""SELECT edge FROM (SELECT DISTINCT unnest(quantile_cont(p, {array(TENTHS)})) AS edge FROM scored)
    WHERE edge > (SELECT min(p) FROM scored) AND edge < (SELECT max(p) FROM scored)"""
UNIFORM = f"SELECT unnest({array(TENTHS[1:-1])}) AS edge"
CALIBRATION_SPEC = "bin:i n:i mean_p:d observed:d min_p:d max_p:d error:d"


# -- rank correlation --------------------------------------------------------------------


def spearman(source: str, x: str, y: str) -> str:
    """Average ranks over complete pairs, then Pearson; NULL for a constant side."""
    return f"""SELECT count(*) AS n, CASE WHEN stddev_pop(rx) > 0 AND stddev_pop(ry) > 0 THEN corr(rx, ry) END AS rho FROM (
        SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
               rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry
        FROM (SELECT {x} AS x, {y} AS y FROM {source}) WHERE x IS NOT NULL AND y IS NOT NULL)"""


DESCRIBE = """count({c}) AS "count", avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS "min",
    quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS "max" """
DESCRIBE_SPEC = 'count:i mean:d std:d min:d q25:d q50:d q75:d max:d'

AGG = """SELECT entity_id, min(group_name) AS group_name, count(*) AS n, avg(y::DOUBLE) AS observed, avg(p) AS predicted,
    avg(p) - avg(y::DOUBLE) AS error
    FROM (SELECT s.*, group_name FROM scored s JOIN customer ON c_custkey = entity_id JOIN grp ON group_code = c_nationkey)
    GROUP BY entity_id"""


def hash_place(key: str, seed: str = "42", by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5(concat('{seed}:', CAST({key} AS VARCHAR))), {key})"


FEATURE_COLUMNS = [
    "entity_id", "entity_name", "group_code", "segment", "outcome_1998", "outcome_1999", "n_sites", "n_sites_rural",
    "n_sites_private", "goal_1999", "goal_2000", "goal_2001", "goal_2002", "goal_2003", "items", "lines", "population",
    "output", "va", "va_agro", "va_industry", "va_services", "balance", "hub", "group_name", "region_name",
    "delta_1998_1999", "gap_1999", "reached_1999", "effort_2000", "ambition_2003", "share_rural", "share_private",
    "items_per_line", "output_per_capita", "share_agro", "log_population", "size_band",
]


# Every numeric feature.
NUMERIC = [c for c in FEATURE_COLUMNS if c not in ("entity_id", "entity_name", "segment", "group_name", "region_name", "size_band")]
LOG_SCALED = ["population", "output", "n_sites", "va", "va_agro", "va_industry", "va_services", "balance"]


def filled(c: str) -> str:
    return f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM store))"


def mode_of(c: str) -> str:
    return f"(SELECT CAST({c} AS VARCHAR) FROM store WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


MATRIX_SPEC = (
    "entity_id:i outcome_t1:d outcome_t2:d delta_t1:d goal_t:d effort_t:d reached_t1:d share_rural:d size_band:s region_name:s"
)
ENRICH_SPEC = (
    "entity_id:i items:d lines:i population:d output:d va:d va_agro:d va_industry:d va_services:d balance:d hub:i group_name:s region_name:s"
)
MONEY = "* REPLACE (round(output, 2) AS output, round(va, 2) AS va, round(va_agro, 2) AS va_agro, round(va_industry, 2) AS va_industry, round(va_services, 2) AS va_services)"


def one_hot(c: str, value: str) -> str:
    """Rows (entity_id, feature, value) for the kept and pooled categories of a filled column."""
    return f"""SELECT e.entity_id, concat('{c}_', cat.category) AS feature, max((e.{c} = cat.v)::INT)::DOUBLE AS value
        FROM (SELECT entity_id, {value} AS {c} FROM store) e CROSS JOIN (
            SELECT {c} AS v, CASE WHEN count(*) >= 20 THEN {c} ELSE 'infrequent' END AS category
            FROM (SELECT {value} AS {c} FROM store) GROUP BY {c}) cat
        GROUP BY e.entity_id, cat.category"""


def scaled(c: str, x: str) -> str:
    return f"""SELECT entity_id, '{c}' AS feature, (x - avg(x) OVER ()) / coalesce(nullif(stddev_pop(x) OVER (), 0), 1) AS value
        FROM (SELECT entity_id, {x} AS x FROM store)"""


def unscaled(c: str, x: str) -> str:
    return f"SELECT entity_id, '{c}' AS feature, ({x})::DOUBLE AS value FROM store"


def log_of(x: str) -> str:
    return f"sign({x}) * ln(1 + abs({x}))"


def shap_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT entity_id, '{c}' AS feature, {w!r}::DOUBLE * (x - avg(x) OVER ()) AS phi FROM (SELECT entity_id, {filled(c)} AS x FROM store)"
        for c, w in SHAP_WEIGHTS.items()
    )


def unpivoted(source: str, ids: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {ids}, '{m}' AS metric, \"{m}\"::DOUBLE AS value FROM {source}" for m in names)


CV = f"""SELECT candidate, metric, avg(value) AS mean, stddev_pop(value) AS sd FROM (
    {unpivoted('per_fold', 'candidate', CV_METRICS)}) GROUP BY candidate, metric"""
PER_FOLD = evaluated("oof", "candidate, fold", "5e-1")


def histogram_sql(source: str, x: str, bins: int, by: str = "") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    groups = f"(SELECT DISTINCT {by} FROM {source} WHERE {x} IS NOT NULL)" if by else f"(SELECT 1 FROM {source} WHERE {x} IS NOT NULL LIMIT 1)"
    filled_bins = f"(SELECT {keys}unnest(range({bins})) AS bin FROM {groups})"
    return f"""SELECT {keys}bin, coalesce(n, 0) AS n FROM {filled_bins} LEFT JOIN (SELECT {keys}bin, count(*) AS n FROM (
        SELECT {keys}least(coalesce(floor((x - lo) / nullif((hi - lo) / {bins}, 0)), 0), {bins - 1}) AS bin FROM (
            SELECT {keys}x, min(x) OVER ({part}) AS lo, max(x) OVER ({part}) AS hi
            FROM (SELECT {keys}{x} AS x FROM {source}) WHERE x IS NOT NULL)) GROUP BY {keys}bin) USING ({keys}bin)"""


def oracle() -> dict[str, str]:
    """SQL per query name; queries that fit models have none."""
    sql: dict[str, str] = {}
    sql["scan_entity"] = select("c_custkey:i c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s", "SELECT * FROM customer")
    sql["scan_units_present"] = select("unit_id:i entity_id:i network:s label:i", "SELECT * FROM pu", "pu")
    sql["enrich_slices"] = select(ENRICH_SPEC, f"SELECT {MONEY} FROM ext", "ext")
    sql["coverage"] = select(
        "source:s coverage:d",
        " UNION ALL ".join(f"SELECT '{c}' AS source, count({c}) / count(*)::DOUBLE AS coverage FROM ext"
                           for c in ("population", "output", "va", "balance", "region_name")),
        "ext",
    )
    sql["materialize_once"] = select("entity_id:i yr:i outcome:d", "SELECT * FROM yearly WHERE outcome IS NOT NULL", "yearly")
    targets = "entity_id:i reached_2000:i outcome_2000:d gap_2000:d"
    sql["publish_table"] = sql["split_targets"] = select(targets, "SELECT * FROM gold", "gold")
    every = METRIC_ORDER + [x.split(":")[0] for x in CELL_SPEC.split()]
    sql["metrics_long"] = select(
        "name:s metric:s value:d", unpivoted("ev", "network AS name", every), "scored", ev=evaluated("scored", "network", "5e-1")
    )
    sql["model_roundtrip"] = select(
        "n:i max_difference:d seed:i", "SELECT count(*) AS n, 0e0 AS max_difference, 42 AS seed FROM m2000 WHERE reached_2000 IS NOT NULL", "m2000"
    )

    sql["normalize_names"] = select("unit_id:i entity_id:i label:i", "SELECT * FROM u", "u")
    sql["drop_dated_columns"] = select(
        "entity_id:i entity_name:s group_code:i segment:s n_sites:i n_sites_rural:i n_sites_private:i goal_2001:d", "SELECT * FROM gold", "gold"
    )
    sql["leakage_scan"] = select(
        "feature:s min_neg:d max_neg:d min_pos:d max_pos:d separates:b",
        "SELECT *, coalesce(max_neg <= min_pos OR max_pos <= min_neg, false) AS separates FROM (" + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, min(CASE WHEN label = 0 THEN {c} END)::DOUBLE AS min_neg, max(CASE WHEN label = 0 THEN {c} END)::DOUBLE AS max_neg,
            min(CASE WHEN label = 1 THEN {c} END)::DOUBLE AS min_pos, max(CASE WHEN label = 1 THEN {c} END)::DOUBLE AS max_pos FROM pu"""
            for c in ("raw_score", "unit_id", "entity_id", "yr")) + ")",
        "pu",
    )
    sql["cluster_matrix"] = select(
        "entity_id:i entity_name:s outcome_1998:d outcome_1999:d n_sites:i n_sites_rural:i n_sites_private:i items:d lines:i population:d "
        "output:d va:d va_agro:d va_industry:d va_services:d balance:d delta_1998_1999:d share_rural:d share_private:d items_per_line:d "
        "output_per_capita:d share_agro:d log_population:d hub:i size_band:s",
        f"SELECT {MONEY} FROM store", "store",
    )
    sql["labelled_only"] = select(
        "entity_id:i reached_2000:i outcome_t1:d", "SELECT * FROM m2000 WHERE reached_2000 IS NOT NULL AND outcome_t1 IS NOT NULL", "m2000"
    )
    sql["hash_sample"] = select(
        "unit_id:i raw_score:d label:i",
        "SELECT * FROM pu WHERE CAST(concat('0x', substr(md5(CAST(unit_id AS VARCHAR)), 1, 8)) AS BIGINT) % 20 = 0", "pu",
    )
    sql["decide_at_threshold"] = select("unit_id:i p:d decision:i", "SELECT *, (p >= 5e-1)::INT AS decision FROM scored", "scored")

    sql["join_one_to_one"] = select(
        "entity_id:i entity_name:s n_sites:i population:d region_name:s",
        "SELECT gold.*, population, region_name FROM gold LEFT JOIN ext ON gold.entity_id = ext.entity_id", "gold ext",
    )
    sql["join_units_to_entity"] = select(
        "unit_id:i entity_id:i network:s label:i region_name:s size_band:s share_rural:d",
        "SELECT pu.*, region_name, size_band, share_rural FROM pu JOIN store ON pu.entity_id = store.entity_id WHERE population IS NOT NULL",
        "pu store",
    )
    sql["join_drop_report"] = select(
        "rows_before:i rows_after:i dropped_pct:d",
        "SELECT *, 100 * (1 - rows_after / rows_before::DOUBLE) AS dropped_pct FROM (SELECT count(*) AS rows_before, count(size.entity_id) AS rows_after "
        "FROM pu LEFT JOIN size ON pu.entity_id = size.entity_id)", "pu size",
    )
    sql["duplicate_keys"] = select(
        "l_orderkey:i l_partkey:i n:i", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1"
    )
    sql["region_lookup"] = select(
        "entity_id:i code:s macro_region:s group_name:s region_name:s",
        """SELECT c_custkey AS entity_id, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code,
        CASE WHEN c_nationkey BETWEEN 11 AND 17 THEN 'N' WHEN c_nationkey BETWEEN 21 AND 29 THEN 'NE'
             WHEN c_nationkey IN (31, 32, 33, 35) THEN 'SE' END AS macro_region, group_name, region_name
        FROM customer LEFT JOIN grp ON group_code = c_nationkey""", "grp",
    )
    sql["relative_matrix_train"] = select(MATRIX_SPEC + " reached_2000:i", "SELECT * FROM m2000", "m2000")
    sql["relative_matrix_project"] = select(MATRIX_SPEC, "SELECT * FROM m2001", "m2001")
    sql["yoy_delta"] = select(
        "entity_id:i yr:i outcome:d previous:d delta:d",
        """SELECT *, outcome - previous AS delta FROM (
        SELECT k.entity_id, k.yr, o.outcome, lag(o.outcome) OVER (PARTITION BY k.entity_id ORDER BY k.yr) AS previous
        FROM (SELECT DISTINCT entity_id, unnest(range(1995, 2002)) AS yr FROM yearly WHERE outcome IS NOT NULL) k
        LEFT JOIN (SELECT * FROM yearly WHERE outcome IS NOT NULL) o ON o.entity_id = k.entity_id AND o.yr = k.yr)""", "yearly",
    )
    sql["ratio_features"] = select(
        "entity_id:i share_rural:d share_private:d items_per_line:d output_per_capita:d share_agro:d", "SELECT * FROM store", "store"
    )
    sql["goal_features"] = select(
        "entity_id:i delta_1998_1999:d gap_1999:d reached_1999:d effort_2000:d ambition_2003:d", "SELECT * FROM store", "store"
    )
    sql["size_features"] = select("entity_id:i population:d log_population:d size_band:s", "SELECT * FROM store", "store")
    sql["symlog"] = select("c_custkey:i log_balance:d", f"SELECT c_custkey, {log_of('c_acctbal')} AS log_balance FROM customer")
    sql["size_band"] = select(
        "o_orderkey:i band:s band_rank:i",
        """SELECT o_orderkey, CASE WHEN o_totalprice <= 0 THEN NULL WHEN o_totalprice <= 5000 THEN 'pequeno_1'
        WHEN o_totalprice <= 20000 THEN 'pequeno_2' WHEN o_totalprice <= 100000 THEN 'medio'
        WHEN o_totalprice <= 500000 THEN 'grande' ELSE 'metropole' END AS band,
        CASE WHEN o_totalprice <= 0 THEN NULL WHEN o_totalprice <= 5000 THEN 0 WHEN o_totalprice <= 20000 THEN 1
        WHEN o_totalprice <= 100000 THEN 2 WHEN o_totalprice <= 500000 THEN 3 ELSE 4 END AS band_rank FROM orders""",
    )

    sql["leakage_evidence"] = select(
        "label:i n:i min_score:d max_score:d separates:b",
        """SELECT *, max(CASE WHEN label = 0 THEN max_score END) OVER () <= min(CASE WHEN label = 1 THEN min_score END) OVER () AS separates
        FROM (SELECT label, count(*) AS n, min(raw_score) AS min_score, max(raw_score) AS max_score FROM pu GROUP BY label)""", "pu",
    )
    sql["rate_by_group"] = select(
        "group_name:s network_name:s n:i rate:d",
        """SELECT group_name, network_name, count(label) AS n, avg(label::DOUBLE) AS rate FROM (
        SELECT group_name, label, CASE substr(network, 1, 1) WHEN '1' THEN 'Federal' WHEN '2' THEN 'Estadual' WHEN '3' THEN 'Municipal'
        WHEN '4' THEN 'Privada' END AS network_name
        FROM pu JOIN customer ON c_custkey = entity_id JOIN grp ON group_code = c_nationkey) GROUP BY ALL""", "pu grp",
    )
    sql["rate_by_band"] = select(
        "size_band:s n:i rate:d band_rank:i",
        """SELECT size_band, count(reached_2000) AS n, avg(reached_2000::DOUBLE) AS rate,
        CASE size_band WHEN 'pequeno_1' THEN 0 WHEN 'pequeno_2' THEN 1 WHEN 'medio' THEN 2 WHEN 'grande' THEN 3 WHEN 'metropole' THEN 4 END AS band_rank
        FROM store GROUP BY size_band""", "store",
    )
    sql["evolution_by_region"] = select(
        "region_name:s outcome_1998:d outcome_1999:d outcome_2000:d",
        "SELECT region_name, avg(outcome_1998) AS outcome_1998, avg(outcome_1999) AS outcome_1999, avg(outcome_2000) AS outcome_2000 FROM store GROUP BY region_name",
        "store",
    )
    sql["describe_by_group"] = select(
        "region_name:s " + DESCRIBE_SPEC, f"SELECT region_name, {DESCRIBE.format(c='outcome_2000')} FROM store GROUP BY region_name", "store"
    )
    sql["effort_by_outcome"] = select(
        "reached_2000:i " + DESCRIBE_SPEC,
        f"SELECT reached_2000, {DESCRIBE.format(c='effort_2000')} FROM store WHERE reached_2000 IS NOT NULL GROUP BY reached_2000", "store",
    )
    sql["gap_by_group"] = select("group_name:s gap_2000:d", "SELECT group_name, avg(gap_2000) AS gap_2000 FROM store GROUP BY group_name", "store")
    sql["missingness"] = select(
        "feature:s missing:d",
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, 1 - count({c}) / count(*)::DOUBLE AS missing FROM store" for c in FEATURE_COLUMNS) + ") WHERE missing > 0",
        "store",
    )
    sql["entity_aggregate"] = select("entity_id:i group_name:s n:i observed:d predicted:d error:d", AGG, "scored grp")
    sql["entity_correlations"] = select(
        "n_entities:i n_large:i pearson:d pearson_large:d mae:d mean_error:d spearman:d",
        f"""SELECT *, (SELECT rho FROM ({spearman('agg', 'predicted', 'observed')})) AS spearman FROM (
        SELECT count(*) AS n_entities, sum((n >= 30)::INT) AS n_large, corr(predicted, observed) AS pearson,
        CASE WHEN sum((n >= 30)::INT) > 2 THEN corr(CASE WHEN n >= 30 THEN predicted END, CASE WHEN n >= 30 THEN observed END) END AS pearson_large,
        avg(abs(error)) AS mae, avg(error) AS mean_error FROM agg)""", "scored grp", agg=AGG,
    )
    sql["spearman_pair"] = select("n:i rho:d", spearman("scored", "p", "y"), "scored")
    sql["spearman_vs_target"] = select(
        "feature:s n:i rho:d",
        " UNION ALL ".join(f"SELECT '{c}' AS feature, * FROM ({spearman('store', c, 'outcome_2000')})" for c in NUMERIC), "store",
    )
    sql["icc"] = select(
        "n_groups:i n:i mean_size:d msb:d msw:d icc:d",
        """SELECT *, (msb - msw) / (msb + (mean_size - 1) * msw) AS icc FROM (
        SELECT count(*) AS n_groups, sum(n) AS n, sum(n) / count(*)::DOUBLE AS mean_size,
        sum(n * (m - grand) * (m - grand)) / (count(*) - 1) AS msb, sum((n - 1) * v) / (sum(n) - count(*)) AS msw FROM (
        SELECT count(label) AS n, avg(label::DOUBLE) AS m, coalesce(var_samp(label::DOUBLE), 0e0) AS v,
        (SELECT avg(label::DOUBLE) FROM pu) AS grand FROM pu GROUP BY entity_id))""", "pu",
    )
    sql["histogram"] = select("bin:i n:i", histogram_sql("store", "outcome_2000", 50), "store")
    sql["histogram_by_class"] = select("label:i bin:i n:i", histogram_sql("pu", "raw_score", 60, "label"), "pu")
    sql["box_stats"] = select(
        "region_name:s q25:d q50:d q75:d whisker_low:d whisker_high:d n_outliers:i",
        """SELECT region_name, max(q25) AS q25, max(q50) AS q50, max(q75) AS q75,
        min(CASE WHEN x BETWEEN q25 - 15e-1 * (q75 - q25) AND q75 + 15e-1 * (q75 - q25) THEN x END) AS whisker_low,
        max(CASE WHEN x BETWEEN q25 - 15e-1 * (q75 - q25) AND q75 + 15e-1 * (q75 - q25) THEN x END) AS whisker_high,
        sum((x < q25 - 15e-1 * (q75 - q25) OR x > q75 + 15e-1 * (q75 - q25))::INT) AS n_outliers FROM (
        SELECT region_name, output_per_capita AS x, quantile_cont(output_per_capita, 0.25) OVER w AS q25,
        quantile_cont(output_per_capita, 0.5) OVER w AS q50, quantile_cont(output_per_capita, 0.75) OVER w AS q75
        FROM store WHERE output_per_capita IS NOT NULL WINDOW w AS (PARTITION BY region_name)) GROUP BY region_name""", "store",
    )
    sql["rate_by_quintile"] = select(
        "band:i n:i rate:d",
        """SELECT band, count(label) AS n, avg(label::DOUBLE) AS rate FROM (SELECT label, 1 + (x > q[1])::INT + (x > q[2])::INT + (x > q[3])::INT + (x > q[4])::INT AS band
        FROM xs CROSS JOIN (SELECT quantile_cont(x, [0.2, 0.4, 0.6, 0.8]) AS q FROM xs)) GROUP BY band""", "pu",
        xs="SELECT label, c_acctbal AS x FROM pu JOIN customer ON c_custkey = entity_id",
    )
    gates = [
        ("unique_grain", "(count(*) - count(DISTINCT entity_id))::DOUBLE", "v = 0"),
        ("all_null_columns", " + ".join(f"(count({c}) = 0)::INT" for c in FEATURE_COLUMNS), "v = 0"),
        *[(f"coverage:{c}", f"count({c}) / count(*)::DOUBLE", "v >= 0.98") for c in ("population", "va", "balance")],
        ("median:population", "quantile_cont(population, 0.5)", "v > 10000 AND v < 1000000"),
        ("p99:share_agro", "quantile_cont(share_agro, 0.99)", "v <= 1"),
        ("p99:share_rural", "quantile_cont(share_rural, 0.99)", "v <= 0.9"),
        ("identity:delta", "coalesce(max(abs(delta_1998_1999 - (outcome_1999 - outcome_1998))), 0)", "v < 1e-6"),
        ("domain:region_name", "sum((NOT coalesce(region_name IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), false))::INT)", "v = 0"),
    ]
    sql["quality_gates"] = select(
        "check:s value:d passed:b",
        " UNION ALL ".join(f"SELECT '{n}' AS \"check\", v::DOUBLE AS value, {ok} AS passed FROM (SELECT {e} AS v FROM store)" for n, e, ok in gates),
        "store",
    )

    sql["impute_median"] = select(
        "entity_id:i " + " ".join(f"{c}:d" for c in NUMERIC),
        "SELECT entity_id, " + ", ".join(f"{filled(c)} AS {c}" for c in NUMERIC) + " FROM store", "store",
    )
    sql["impute_mode"] = select(
        "entity_id:i size_band:s hub:s", f"SELECT entity_id, coalesce(size_band, {mode_of('size_band')}) AS size_band, hub FROM store", "store"
    )
    sql["standardize"] = select(
        "entity_id:i " + " ".join(f"{c}:d" for c in NUMERIC),
        "SELECT entity_id, " + ", ".join(
            f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in NUMERIC) + " FROM store",
        "store",
    )
    sql["one_hot_counts"] = select(
        "feature:s category:s n:i",
        "SELECT feature, category, sum(n) AS n FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CASE WHEN count(*) >= 20 THEN {c} ELSE 'infrequent' END AS category, count(*) AS n FROM store WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ("group_name", "size_band")) + ") GROUP BY feature, category", "store",
    )
    for name, numeric in (("preprocess_matrix", scaled), ("preprocess_matrix_unscaled", unscaled)):
        sql[name] = select(
            "entity_id:i feature:s value:d",
            " UNION ALL ".join([
                *[numeric(c, log_of(filled(c)) if c in LOG_SCALED else filled(c)) for c in NUMERIC if c != "hub"],
                *[one_hot(c, f"coalesce(CAST({c} AS VARCHAR), {mode_of(c)})") for c in ("group_name", "region_name", "size_band", "hub")],
            ]), "store",
        )

    sql["stratified_holdout"] = select(
        "unit_id:i label:i split:s",
        f"""SELECT unit_id, label, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
        SELECT *, {hash_place('unit_id', by='label')} AS rn, count(*) OVER (PARTITION BY label) AS n FROM pu)""", "pu",
    )
    sql["split_summary"] = select(
        "split:s n:i positive_rate:d",
        f"""SELECT split, count(*) AS n, avg(label::DOUBLE) AS positive_rate FROM (SELECT label, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, {hash_place('unit_id', by='label')} AS rn, count(*) OVER (PARTITION BY label) AS n FROM pu)) GROUP BY split""", "pu",
    )
    sql["stratified_folds"] = select(
        "unit_id:i label:i fold:i", f"SELECT unit_id, label, ({hash_place('unit_id', by='label')} - 1) % 5 AS fold FROM pu", "pu"
    )
    sql["group_folds"] = select(
        "entity_id:i n:i fold:i",
        """SELECT entity_id, n, CASE WHEN (place // 5) % 2 = 0 THEN place % 5 ELSE 4 - place % 5 END AS fold FROM (
        SELECT *, row_number() OVER (ORDER BY n DESC, md5(concat('42:', CAST(entity_id AS VARCHAR))), entity_id) - 1 AS place
        FROM (SELECT entity_id, count(*) AS n FROM pu GROUP BY entity_id))""", "pu",
    )
    sql["fold_group_overlap"] = select(
        "entity_id:i min_fold:i max_fold:i folds:s",
        f"""SELECT entity_id, min(fold) AS min_fold, max(fold) AS max_fold, 'label' AS folds
        FROM (SELECT entity_id, ({hash_place('unit_id', by='label')} - 1) % 2 AS fold FROM pu) GROUP BY entity_id HAVING min(fold) <> max(fold)""", "pu",
    )
    sql["stratified_sample"] = select(
        "unit_id:i entity_id:i network:s label:i",
        f"""SELECT * FROM (SELECT *, {hash_place('unit_id', by='network, label')} AS rn, count(*) OVER (PARTITION BY network, label) AS n,
        count(*) OVER () AS total FROM pu) WHERE total <= 3000 OR rn <= round(n * (3000 / total::DOUBLE))""", "pu",
    )
    sql["subsample_n"] = select(
        "unit_id:i label:i", f"SELECT * FROM (SELECT *, {hash_place('unit_id')} AS rn FROM pu) WHERE rn <= 2000", "pu"
    )

    sql["score_violations"] = select(
        "n:i n_missing:i n_bad_label:i n_out_of_range:i",
        """SELECT count(*) AS n, sum((y IS NULL OR p IS NULL)::INT) AS n_missing, sum((y NOT IN (0, 1))::INT) AS n_bad_label,
        sum((p < 0 OR p > 1)::INT) AS n_out_of_range FROM (SELECT y, p FROM scored UNION ALL SELECT label, raw_score / 4e5 FROM u)""", "scored",
    )
    sql["confusion"] = select(
        CELL_SPEC, f"SELECT *, fp AS miss_risk, fn AS false_alarm FROM ({cells('scored', '', '5e-1')})", "scored"
    )
    sql["confusion_pct"] = select(
        "actual:i predicted:i n:i pct:d",
        """SELECT y AS actual, (p >= 5e-1)::INT AS predicted, count(*) AS n, 100 * count(*) / sum(count(*)) OVER (PARTITION BY y)::DOUBLE AS pct
        FROM scored GROUP BY y, (p >= 5e-1)::INT""", "scored",
    )
    sql["binary_metrics"] = select(f"{METRIC_SPEC} {CELL_SPEC}", evaluated("scored", "", "5e-1"), "scored")
    sql["roc_auc"] = select("network:s roc_auc:d", ranking("scored", "network"), "scored")
    sql["average_precision"] = select("pr_auc:d", ranking("scored"), "scored")
    sql["average_precision_risk"] = select("pr_auc_risk:d", ranking("scored"), "scored")
    sql["brier_logloss"] = select("brier:d log_loss:d", cells("scored", "", "5e-1"), "scored")
    swept = f"SELECT *, {NAMED_RATES} FROM (SELECT *, {RATES} FROM ({SWEEP}))"
    sql["threshold_f1"] = select(
        "threshold:d f1:d", "SELECT threshold, f1 FROM swept ORDER BY f1 DESC, threshold LIMIT 1", "scored", grid=GRID, swept=swept
    )
    sql["threshold_f1_risk"] = select(
        "threshold:d f1:d", "SELECT threshold, f1_risk AS f1 FROM swept ORDER BY f1_risk DESC, threshold LIMIT 1", "scored", grid=GRID, swept=swept
    )
    sql["threshold_cost"] = select(
        "threshold:d cost:d",
        "SELECT threshold, (5e0 * fp + 1e0 * fn) / (tn + fp + fn + tp) AS cost FROM swept ORDER BY cost, threshold LIMIT 1", "scored", grid=GRID, swept=swept,
    )
    sql["calibration_table"] = select(CALIBRATION_SPEC, calibration("SELECT edge FROM deciles"), "scored", deciles=DECILES)
    sql["calibration_uniform"] = select(CALIBRATION_SPEC, calibration(UNIFORM), "scored")
    sql["ece"] = select(
        "ece:d", "SELECT sum(n * abs(error)) / sum(n) AS ece FROM bins", "scored", deciles=DECILES, bins=calibration("SELECT edge FROM deciles")
    )
    sql["roc_curve"] = select(
        "threshold:d fpr:d tpr:d",
        f"""SELECT p AS threshold, (neg_all - neg_upto + neg) / neg_all::DOUBLE AS fpr, (pos_all - pos_upto + pos) / pos_all::DOUBLE AS tpr
        FROM ({totals('scored')})""", "scored",
    )
    sql["pr_curve"] = select(
        "threshold:d recall:d precision:d",
        f"""SELECT p AS threshold, (pos_all - pos_upto + pos) / pos_all::DOUBLE AS recall,
        (pos_all - pos_upto + pos) / (pos_all - pos_upto + pos + neg_all - neg_upto + neg)::DOUBLE AS "precision" FROM ({totals('scored')})""", "scored",
    )
    sql["operating_points"] = select(
        "threshold:d tn:i fp:i fn:i tp:i f1:d f1_risk:d balanced_accuracy:d accuracy:d precision:d recall:d precision_risk:d recall_risk:d flagged:i",
        "SELECT *, tn + fn AS flagged FROM swept", "scored",
        grid=f"SELECT unnest({array(OPERATING_CUTS)}) AS threshold", swept=swept,
    )

    sql["dummy_scores"] = select(
        "unit_id:i p:d", "SELECT unit_id, CASE WHEN (SELECT avg(label::DOUBLE) FROM pu) > 5e-1 THEN 1e0 ELSE 0e0 END AS p FROM pu", "pu"
    )
    sql["class_weights"] = select(
        "label:i n:i weight:d", "SELECT label, count(*) AS n, (SELECT count(*) FROM pu) / (2e0 * count(*)) AS weight FROM pu GROUP BY label", "pu"
    )
    sql["cv_report"] = select("candidate:s metric:s mean:d sd:d", CV, "oof", per_fold=PER_FOLD)
    sql["best_candidate"] = select(
        "candidate:s mean:d",
        f"SELECT candidate, mean FROM ({CV}) WHERE metric = 'roc_auc' AND candidate <> 'dummy' ORDER BY mean DESC, candidate LIMIT 1",
        "oof", per_fold=PER_FOLD,
    )
    sql["holdout_table"] = select(
        f"name:s {METRIC_SPEC} {CELL_SPEC}",
        " UNION ALL BY NAME ".join(
            [f"SELECT * FROM ({evaluated('named', 'name', '5e-1')})"]
            + [f"SELECT * REPLACE ('mixed@{k}' AS name) FROM ({evaluated('mixed', 'name', f'{v!r}::DOUBLE')})" for k, v in HOLDOUT_CUTS.items()]),
        "oof", named="SELECT candidate AS name, y, p FROM oof", mixed="SELECT candidate AS name, y, p FROM oof WHERE candidate = 'mixed'",
    )
    sql["risk_ranking"] = select(
        "position:i entity_id:i risk:d",
        'SELECT row_number() OVER (ORDER BY risk DESC, entity_id) AS "position", entity_id, risk FROM projected', "projected",
    )
    sql["top_k_risk"] = select(
        "entity_id:i entity_name:s group_name:s risk:d goal:d last_outcome:d effort:d reached_last:i",
        "SELECT * FROM projected ORDER BY risk DESC, entity_id LIMIT 10", "projected",
    )
    sql["topk_concentration"] = select(
        "group_name:s n:i share:d",
        "SELECT group_name, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM (SELECT * FROM projected ORDER BY risk DESC, entity_id LIMIT 100) GROUP BY group_name",
        "projected",
    )
    sql["ranking_sanity"] = select(
        "spearman_risk_effort:d risk_missed:d risk_met:d",
        f"""SELECT (SELECT rho FROM ({spearman('projected', 'risk', 'effort')})) AS spearman_risk_effort,
        avg(CASE WHEN reached_last = 0 THEN risk END) AS risk_missed, avg(CASE WHEN reached_last = 1 THEN risk END) AS risk_met FROM projected""",
        "projected",
    )

    medians = "SELECT segment, " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMERIC) + " FROM store GROUP BY segment"
    sql["segment_profile"] = select("segment:s " + " ".join(f"{c}:d" for c in NUMERIC), medians, "store")
    sql["segment_names"] = select(
        "segment:s segment_name:s",
        """SELECT segment, concat_ws(' ', CASE WHEN outcome_1999 >= (SELECT quantile_cont(outcome_1999, 0.5) FROM prof) THEN 'alto desempenho' ELSE 'baixo desempenho' END,
        CASE WHEN share_rural >= 0.5 THEN 'rural' ELSE 'urbano' END,
        CASE WHEN population >= 100000 THEN 'grande' WHEN population >= 20000 THEN 'médio' ELSE 'pequeno' END) AS segment_name FROM prof""",
        "store", prof=medians,
    )
    sql["segment_outcome"] = select(
        "segment:s n:i rate:d",
        "SELECT segment, count(*) AS n, avg(reached_2000::DOUBLE) AS rate FROM store WHERE reached_2000 IS NOT NULL GROUP BY segment", "store",
    )
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    counts = ", ".join(f"CAST(sum((region_name = '{r}')::INT) AS BIGINT) AS \"{r}\"" for r in regions)
    sql["segment_by_region"] = with_parts(f"SELECT segment, {counts} FROM store GROUP BY segment", "store")
    pairs = """SELECT a.vec_id, a.label AS own, b.label AS other, sum({d}) AS total,
        count(*) AS n FROM vecs a CROSS JOIN vecs b GROUP BY a.vec_id, a.label, b.label"""
    width = """SELECT avg(CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
        SELECT vec_id, max(CASE WHEN own = other THEN n END) AS own_n, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
        min(CASE WHEN own <> other THEN total / n END) AS b FROM dist GROUP BY vec_id)"""
    vecs = "SELECT vec_id, label, embedding::DOUBLE[64] AS e FROM embeddings"
    sql["silhouette_centroid"] = select(
        "silhouette:d",
        """SELECT avg(CASE WHEN greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
        SELECT vec_id, max(CASE WHEN own = other THEN d END) AS a, min(CASE WHEN own <> other THEN d END) AS b FROM (
        SELECT vec_id, v.label AS own, c.label AS other, array_distance(e, c) AS d FROM vecs v CROSS JOIN centres c) GROUP BY vec_id)""",
        "", vecs=vecs, centres="""SELECT label, list(m ORDER BY i)::DOUBLE[64] AS c FROM (
        SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(e::DOUBLE[]) AS x, unnest(range(64)) AS i FROM vecs) GROUP BY label, i) GROUP BY label""",
    )
    sql["silhouette_squared"] = select(
        "silhouette:d", width, "", vecs=vecs, dist=pairs.format(d="array_distance(a.e, b.e) * array_distance(a.e, b.e)")
    )

    sql["linear_shap"] = select("entity_id:i feature:s phi:d", shap_rows(), "store")
    sql["shap_ranking"] = select(
        "feature:s mean_abs:d",
        f"SELECT feature, avg(abs(phi)) AS mean_abs FROM ({shap_rows()}) GROUP BY feature ORDER BY mean_abs DESC, feature LIMIT 15", "store",
    )
    names = list(IMPORTANCE_WEIGHTS)
    known = "(SELECT * FROM store WHERE reached_2000 IS NOT NULL)"
    base = "SELECT entity_id, reached_2000 AS y, " + ", ".join(
        f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {known})) AS {c}" for c in names
    ) + f" FROM {known}"
    to = f"SELECT *, {hash_place('entity_id', '42/to')} AS place FROM base"
    copies = ["SELECT '' AS feature, -1 AS rep, y, " + ", ".join(names) + " FROM base"]
    for r in range(3):
        give = f"SELECT *, {hash_place('entity_id', f'42/from/{r}')} AS place FROM base"
        for f in names:
            mixed = ", ".join(f"{'b' if c == f else 'a'}.{c}" for c in names)
            copies.append(f"SELECT '{f}', {r}, a.y, {mixed} FROM ({to}) a JOIN ({give}) b USING (place)")
    logit = " + ".join(f"{w!r}::DOUBLE * {c}" for c, w in IMPORTANCE_WEIGHTS.items())
    sql["permutation_importance"] = select(
        "feature:s importance_mean:d importance_sd:d",
        f"""SELECT feature, avg(gain) AS importance_mean, stddev_pop(gain) AS importance_sd FROM (
        SELECT feature, (SELECT roc_auc FROM aucs WHERE feature = '') - roc_auc AS gain FROM aucs WHERE feature <> '') GROUP BY feature""",
        "store", base=base, copies=" UNION ALL ".join(copies),
        rated=f"SELECT feature, rep, y, floor(1e3 / (1e0 + exp(-({logit}))) + 5e-1) / 1e3 AS p FROM copies",
        aucs=ranking("rated", "feature, rep"),
    )
    sql["permuted_column"] = select(
        "unit_id:i raw_score:d permuted:d",
        f"""SELECT a.unit_id, a.raw_score, b.raw_score AS permuted
        FROM (SELECT *, {hash_place('unit_id', '42/to')} AS place FROM pu) a
        JOIN (SELECT *, {hash_place('unit_id', '42/from/0')} AS place FROM pu) b USING (place)""", "pu",
    )
    planted = """SELECT *, population::DOUBLE AS planted_copy, CASE WHEN entity_id % 7 > 0 THEN population END AS planted_gaps, -population AS planted_reverse,
        CASE WHEN entity_id % 50 > 0 THEN population ELSE population + 1 END AS planted_miss, group_name AS planted_name FROM store"""
    numbers = [*NUMERIC, "planted_copy", "planted_gaps", "planted_reverse", "planted_miss"]
    texts = [c for c in FEATURE_COLUMNS if c not in NUMERIC and c != "entity_id"] + ["planted_name"]
    names = [c for c in FEATURE_COLUMNS if c != "entity_id"] + ["planted_copy", "planted_gaps", "planted_reverse", "planted_miss", "planted_name"]
    judged = []
    for a, b in combinations(names, 2):
        if (a in texts) != (b in texts):
            continue
        order = f"""(SELECT CASE WHEN count(DISTINCT x) < 2 THEN NULL WHEN bool_and(rx = ry) THEN 'increasing' WHEN bool_and(rx + ry + ties = n + 2) THEN 'decreasing' END
            FROM (SELECT x, rank() OVER (ORDER BY x) AS rx, rank() OVER (ORDER BY y) AS ry, count(*) OVER (PARTITION BY x, y) AS ties, count(*) OVER () AS n
            FROM (SELECT {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM wide WHERE {a} IS NOT NULL AND {b} IS NOT NULL)))"""
        judged.append(
            f"""SELECT '{a}' AS left_column, '{b}' AS right_column, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n_both,
            CASE WHEN count(*) FILTER ({a} = {b}) = 0 AND count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) = 0 THEN NULL
            WHEN count(*) FILTER ({a} <> {b}) = 0 THEN CASE WHEN count(*) FILTER ({a} IS NULL <> ({b} IS NULL)) > 0 THEN 'copy_where_present' ELSE 'copy' END
            ELSE {order if a not in texts else 'NULL'} END AS kind FROM wide"""
        )
    sql["duplicate_columns"] = select(
        "left_column:s right_column:s kind:s n_both:i", f"SELECT * FROM ({' UNION ALL '.join(judged)}) WHERE kind IS NOT NULL", "store", wide=planted
    )
    # Facts about fits: sizes from the tables, and what must hold for any fit.
    labelled = "(SELECT * FROM m2000 WHERE reached_2000 IS NOT NULL)"
    halves = f"""SELECT count(*) FILTER (rn > round(n * 2e-1)) AS n_train, count(*) FILTER (rn <= round(n * 2e-1)) AS n_test,
        count(*) FILTER (rn <= round(n * 2e-1) AND reached_2000 = 1) AS positives FROM (
        SELECT *, {hash_place('entity_id', by='reached_2000')} AS rn, count(*) OVER (PARTITION BY reached_2000) AS n FROM {labelled})"""
    audits = {"fit_logreg": ["gradient_is_zero"], "fit_forest": ["leaves_add_up"]}
    audits |= {name: ["leaves_add_up", "leaves_are_full", "loss_falls"] for name in ("fit_gbt", "fit_gbt_subsampled")}
    for name, facts in audits.items():
        facts = ["train_auc_above_majority", *facts]
        sql[name] = select(
            "n_train:i n_test:i positives:i " + " ".join(f"{f}:b" for f in facts), "SELECT *, " + ", ".join(f"true AS {f}" for f in facts) + f" FROM ({halves})", "m2000"
        )
    sql["learning_curve"] = select(
        "size:i n_train:i n_test:i train_above_majority:b last_is_the_fit:b",
        f"SELECT unnest([50, 100, 200, 400, 600, 800]) AS size, n_train, n_test, true AS train_above_majority, true AS last_is_the_fit FROM ({halves})", "m2000",
    )
    sql["random_search"] = "SELECT 12::BIGINT AS n_settings, 1::BIGINT AS n_best, true AS best_is_greatest, true AS best_is_returned"
    sql["ablation"] = select(
        "n_test:i n_dropped:i n_variants:i same_settings:b", f"SELECT n_test, 6 AS n_dropped, 4 AS n_variants, true AS same_settings FROM ({halves})", "m2000"
    )
    sql["project_and_rank"] = select(
        "n:i n_entities:i first:i last:i valid:b",
        "SELECT count(*) AS n, count(DISTINCT entity_id) AS n_entities, 1 AS first, count(*) AS last, true AS valid FROM m2001", "m2001",
    )
    sql["train_save_rank"] = select(
        "n_ranked:i n_positions:i seed:i same_thresholds:b has_metrics:b",
        "SELECT count(*) AS n_ranked, count(*) AS n_positions, 42 AS seed, true AS same_thresholds, true AS has_metrics FROM m2001", "m2001",
    )
    sql["fitted_shap"] = select("n:i adds_up:b named:b", f"SELECT n_test AS n, true AS adds_up, true AS named FROM ({halves})", "m2000")
    sql["fitted_importance"] = "SELECT 0::BIGINT AS n_columns, true AS bounded"
    sql["select_k"] = "SELECT 6::BIGINT AS n_k, 1::BIGINT AS n_best, true AS best_is_greatest, true AS in_range"
    sql["kmeans_segments"] = "SELECT count(*)::BIGINT AS n, 3::BIGINT AS k, true AS same_inertia FROM customer"
    sql["segment_entities"] = "SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS n_entities, true AS named, true AS chosen FROM customer"
    return sql
