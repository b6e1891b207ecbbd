"""DuckDB SQL that grows the catalog's ensembles itself: cuts, gains, samples, bags, contributions."""

from __future__ import annotations

import math

from basketry.functions.ordering import SAMPLE_PRIME, sample_factors
from basketry.operators.attribution import _shapley_weights
from basketry.operators.bagging import poisson_bounds
from basketry.operators.boosting import LEAST_GAIN, Boosting, sampled_columns
from basketry.operators.models import leafwise_settings, second_order_settings
from basketry.plans.catalog import ENSEMBLES
from basketry.settings import FEATURES, SEED

_VALUE = "CASE place " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(FEATURES)) + " END"


def key_hash(seed: int) -> str:
    """Two rounds modulo a prime in 128-bit whole numbers."""
    p, (a, b, c, d) = SAMPLE_PRIME, sample_factors(seed)
    first = (
        f"((((product_id::HUGEINT % {p} + {p}) % {p}) * {a}::HUGEINT % {p}"
        f" + (date - DATE '1970-01-01' + 1000000)::HUGEINT * {b}::HUGEINT % {p} + {c}) % {p})"
    )
    return f"(({first} * {first} % {p}) * {d}::HUGEINT % {p})"


def _points(rows: str, places, extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {k} AS place, {FEATURES[k]} AS v{extra} FROM {rows}" for k in places)


def _levels(name: str, rows: str) -> str:
    """CTE with the cut after each value of each feature."""
    return f"""
levels_{name} AS (
  SELECT place, v, (v + lead(v) OVER (PARTITION BY place ORDER BY v)) / 2 AS cut
  FROM (SELECT DISTINCT place, v FROM ({_points(rows, range(len(FEATURES)))}))
)"""


def _step(before: str, after: str, splits: str, sign: str) -> str:
    """CTE ``after``: the rows of ``before`` one split further down."""
    return f"""
{after} AS (
  SELECT b.* EXCLUDE (node), CASE WHEN cut IS NULL THEN b.node
    ELSE b.node || CASE WHEN {_VALUE} {sign} cut THEN '0' ELSE '1' END END AS node
  FROM {before} b LEFT JOIN {splits} s ON b.node = s.node
)"""


def _tree(
    t: str, rows: str, levels: str, depth: int, places, l2: float, least: int, weight: float, unit: str,
    rate: float = 1.0, sign: str = "<", only_best: bool = False,
) -> str:
    """CTEs ``s<k>_t`` (splits of level k) and ``leaves_t``, from rows with ``g`` and ``w``."""
    out = [f"\nn0_{t} AS (SELECT *, '' AS node FROM {rows})"]
    for k in range(1, depth + 1):
        order = "ORDER BY gain DESC, node LIMIT 1" if only_best and k == depth else ""
        sums = _points(f"n{k - 1}_{t}", places, ", node, g, w")
        out.append(f"""
s{k}_{t} AS (
  SELECT * FROM (
    SELECT node, place, cut, a * a / (wl + {l2!r}) + b * b / (wr + {l2!r}) - (total * total) / (wl + wr + {l2!r}) AS gain
    FROM (
      SELECT node, place, cut, CAST(gl AS DOUBLE) / {unit} AS a, CAST(gt - gl AS DOUBLE) / {unit} AS b,
        CAST(gt AS DOUBLE) / {unit} AS total, CAST(wl AS DOUBLE) AS wl, CAST(wt - wl AS DOUBLE) AS wr, nl, nt - nl AS nr
      FROM (
        SELECT node, place, v, sum(g) OVER w AS gl, sum(w) OVER w AS wl, sum(n) OVER w AS nl,
          sum(g) OVER o AS gt, sum(w) OVER o AS wt, sum(n) OVER o AS nt
        FROM (SELECT node, place, v, sum(g) AS g, sum(w) AS w, count(*) AS n FROM ({sums}) GROUP BY ALL)
        WINDOW w AS (PARTITION BY node, place ORDER BY v), o AS (PARTITION BY node, place))
      JOIN {levels} USING (place, v))
    WHERE cut IS NOT NULL AND nl >= {least} AND nr >= {least} AND wl >= {weight!r} AND wr >= {weight!r})
  WHERE gain > {LEAST_GAIN!r}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, cut) = 1 {order}
)""")
        out.append(_step(f"n{k - 1}_{t}", f"n{k}_{t}", f"s{k}_{t}", sign))
    out.append(f"""
leaves_{t} AS (
  SELECT node, {rate!r} * ((CAST(sum(g) AS DOUBLE) / {unit}) / (sum(w) + {l2!r})) AS value, sum(w) AS cover
  FROM n{depth}_{t} GROUP BY node
)""")
    return ",".join(out)


def _walk(t: str, before: str, after: str, depth: int, sign: str = "<") -> str:
    """CTE ``after``: the rows of ``before`` with ``value``, what the tree says."""
    out = [f"\nw0_{t} AS (SELECT *, '' AS node FROM {before})"]
    out += [_step(f"w{k - 1}_{t}", f"w{k}_{t}", f"s{k}_{t}", sign) for k in range(1, depth + 1)]
    out.append(f"\n{after} AS (SELECT w.* EXCLUDE (node), value FROM w{depth}_{t} w JOIN leaves_{t} USING (node))")
    return ",".join(out)


def _rows(name: str) -> str:
    values = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in FEATURES)
    return f"""
rows_{name} AS (
  SELECT product_id, date, side, CAST(purchases_next_day AS DOUBLE) AS y, {values} FROM sides_{name}
),
learn_{name} AS (SELECT * FROM rows_{name} WHERE side = 'train')"""


def _boosted(name: str, model: str, how: Boosting, depth: int) -> str:
    """CTE ``m<rounds>_<name>_<model>`` with the forecast ``m`` of every row."""
    own = f"{name}_{model}"
    grow = how.growth
    out = [f"""
m0_{own} AS (
  SELECT *, (SELECT CAST(sum(CAST(floor(y * 65536 + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE) / 65536.0::DOUBLE / count(*)
             FROM learn_{name}) AS m FROM rows_{name}
)"""]
    for r in range(how.rounds):
        t = f"{own}_{r}"
        sampled = "" if how.subsample == 1 else (
            f" AND {key_hash(SEED * 1_000_003 + r)} < {math.floor(how.subsample * SAMPLE_PRIME)}"
        )
        out.append(f"""
g_{t} AS (
  SELECT *, CAST(floor((y - m) * 65536 + 0.5::DOUBLE) AS BIGINT) AS g, 1 AS w FROM m{r}_{own}
  WHERE side = 'train'{sampled}
)""")
        places = sampled_columns(SEED, r, how.colsample, len(FEATURES))
        out.append(_tree(t, f"g_{t}", f"levels_{name}", depth, places, grow.l2, grow.min_rows, grow.min_weight,
                         "65536.0::DOUBLE", how.learning_rate, only_best=grow.max_leaves is not None))
        out.append(_walk(t, f"m{r}_{own}", f"v_{t}", depth))
        out.append(f"\nm{r + 1}_{own} AS (SELECT * EXCLUDE (m, value), m + value AS m FROM v_{t})")
    return ",".join(out)


def _forest(name: str) -> str:
    """CTE ``m_<name>_forest`` with the mean forecast ``m`` of every row."""
    p = ENSEMBLES["forest_keyed"]
    n, depth = p["n_estimators"], p["max_depth"]
    out, before = [], f"rows_{name}"
    for k in range(n):
        t = f"{name}_forest_{k}"
        hashed = key_hash(SEED * 1_000_003 + k)
        drawn = " + ".join(f"(h >= {b})::INT" for b in poisson_bounds())
        out.append(f"""
d_{t} AS (
  SELECT *, w * y AS g FROM (SELECT *, {drawn} AS w FROM (SELECT *, {hashed} AS h FROM learn_{name})) WHERE w > 0
)""")
        out.append(_levels(t, f"d_{t}"))
        out.append(_tree(t, f"d_{t}", f"levels_{t}", depth, range(len(FEATURES)), 0.0, p["min_samples_leaf"], 0.0,
                         "1.0::DOUBLE", sign="<="))
        out.append(_walk(t, before, f"v_{t}", depth, "<="))
        total = "value" if k == 0 else "total + value"
        drop = "value" if k == 0 else "value, total"
        before = f"f_{t}"
        out.append(f"\n{before} AS (SELECT * EXCLUDE ({drop}), {total} AS total FROM v_{t})")
    out.append(f"\nm_{name}_forest AS (SELECT *, total / {n} AS m FROM {before})")
    return ",".join(out)


_HOW = {
    "gbt_second_order": second_order_settings(ENSEMBLES["gbt_second_order"]),
    "gbt_leafwise": leafwise_settings(ENSEMBLES["gbt_leafwise"]),
}
_DEPTH = 2  # of both: a limit of two, and three leaves


def forecasts(name: str, models=tuple(ENSEMBLES)) -> str:
    """CTEs with the forecasts of the models on the split ``name``; see ``forecast_of``."""
    parts = [_rows(name), _levels(name, f"learn_{name}")]
    for model in models:
        parts.append(_forest(name) if model == "forest_keyed" else _boosted(name, model, _HOW[model], _DEPTH))
    return ",".join(parts)


def forecast_of(name: str, model: str) -> str:
    """CTE that holds the forecast ``m`` of a model for each row (product_id, date, side)."""
    return f"m_{name}_forest" if model == "forest_keyed" else f"m{_HOW[model].rounds}_{name}_{model}"


def contributions(name: str, sample: str) -> str:
    """CTE ``phi``: Shapley values of the second-order model's trees from all 128 coalitions."""
    own, how = f"{name}_gbt_second_order", _HOW["gbt_second_order"]
    parts = []
    for r in range(how.rounds):
        t = f"{own}_{r}"
        parts.append(f"""
paths_{t} AS (
  SELECT l.node, value, a.place AS p1, a.cut AS c1, b.place AS p2, b.cut AS c2,
    (SELECT sum(cover) FROM leaves_{t}) AS n0,
    (SELECT sum(cover) FROM leaves_{t} x WHERE length(l.node) > 0 AND x.node[1] = l.node[1]) AS n1, cover AS n2
  FROM leaves_{t} l LEFT JOIN s1_{t} a ON length(l.node) > 0 LEFT JOIN s2_{t} b ON length(l.node) > 1 AND b.node = l.node[1]
)""")

    def factor(k: int) -> str:
        value = "CASE p" + str(k) + " " + " ".join(f"WHEN {j} THEN {c}" for j, c in enumerate(FEATURES)) + " END"
        side = f"CASE WHEN {value} < c{k} THEN '0' ELSE '1' END = node[{k}]"
        return (
            f"CASE WHEN p{k} IS NULL THEN 1.0::DOUBLE WHEN (mask >> p{k}) & 1 = 1 THEN CAST({side} AS INT)::DOUBLE "
            f"ELSE CAST(n{k} AS DOUBLE) / n{k - 1} END"
        )

    every = " UNION ALL ".join(f"SELECT * FROM paths_{own}_{r}" for r in range(how.rounds))
    weights = _shapley_weights(len(FEATURES))
    phi = ", ".join(f"sum(list_extract([{', '.join(map(repr, w))}], mask + 1)::DOUBLE * v) AS phi_{c}" for c, w in zip(FEATURES, weights))
    full = 2 ** len(FEATURES) - 1
    parts.append(f"""
worth AS (
  SELECT product_id, date, mask, any_value(base) + sum(value * {factor(1)} * {factor(2)}) AS v
  FROM {sample}, (SELECT unnest(range({full + 1})) AS mask), ({every}),
    (SELECT any_value(m) AS base FROM m0_{own}) GROUP BY ALL
),
phi AS (
  SELECT product_id, date, max(v) FILTER (mask = 0) AS base_value, max(v) FILTER (mask = {full}) AS prediction, {phi}
  FROM worth GROUP BY ALL
)""")
    return ",".join(parts)
