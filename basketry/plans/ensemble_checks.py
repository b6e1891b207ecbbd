"""DuckDB SQL that grows ensembles of any size: a recursion over trees, with the levels of a tree written out.

Unlike ``tree_checks``, whose SQL has a few CTEs for each level of each tree, the text does not grow with the number of
trees. A node has the number 1 at the root and 2n, 2n + 1 below n. Rows of equal features go down a tree together: each
tree sums what it needs by feature vector (``kind``) first.
"""

from __future__ import annotations

import math

from basketry.functions.ordering import SAMPLE_PRIME, sample_factors
from basketry.operators.bagging import poisson_bounds
from basketry.operators.boosting import LEAST_GAIN, Boosting, sampled_columns
from basketry.operators.models import leafwise_settings, second_order_settings
from basketry.settings import FEATURES, MODEL_DEFAULTS, SEED

_NAMES = ", ".join(FEATURES)
_VALUE = "CASE place " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(FEATURES)) + " END"
_FULL = 2 ** len(FEATURES) - 1
# in grouping sets of one feature each
_PLACE = f"CASE GROUPING({_NAMES}) " + " ".join(
    f"WHEN {_FULL ^ (1 << (len(FEATURES) - 1 - k))} THEN {k}" for k in range(len(FEATURES))
) + " END"

_HOW = {"gbt_second_order": second_order_settings(), "gbt_leafwise": leafwise_settings()}


def _sets(*also: str) -> str:
    return f"GROUPING SETS ({', '.join(f'({", ".join((*also, c))})' for c in FEATURES)})"


def _hash() -> str:
    """``tree_checks.key_hash`` with its factors as columns."""
    p = SAMPLE_PRIME
    first = f"((own * a % {p} + day * b % {p} + c) % {p})"
    return f"({first} * {first} % {p} * d % {p})"


def _factors(trees: int, columns=lambda tree: range(len(FEATURES))) -> str:
    """Rows of VALUES: a tree's number, the factors of its hash, the features it may split on."""
    rows = []
    for t in range(trees):
        numbers = ", ".join(f"{x}::HUGEINT" for x in sample_factors(SEED * 1_000_003 + t))
        rows.append(f"({t}, {numbers}, {list(columns(t))})")
    return ", ".join(rows)


def _rows(name: str) -> str:
    values = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in FEATURES)
    return f"""
full_{name} AS MATERIALIZED (
  SELECT ((product_id::HUGEINT % {SAMPLE_PRIME} + {SAMPLE_PRIME}) % {SAMPLE_PRIME}) AS own,
    (date - DATE '1970-01-01' + 1000000)::HUGEINT AS day, side, CAST(purchases_next_day AS DOUBLE) AS y, {values}
  FROM sides_{name}
),
kinds_{name} AS MATERIALIZED (
  SELECT row_number() OVER () AS kind, {_NAMES} FROM (SELECT DISTINCT {_NAMES} FROM full_{name})
),
all_{name} AS MATERIALIZED (SELECT own, day, side, y, kind FROM full_{name} JOIN kinds_{name} USING ({_NAMES}))"""


def _levels(cte: str, rows: str) -> str:
    """CTE with the cut after each value of each feature."""
    return f"""
{cte} AS MATERIALIZED (
  SELECT place, v, (v + lead(v) OVER (PARTITION BY place ORDER BY v)) / 2 AS cut
  FROM (SELECT {_PLACE} AS place, coalesce({_NAMES}) AS v FROM {rows} GROUP BY {_sets()})
)"""


def _split(k: int, levels: str, sums: str, gain: str, enough: str, least: str, key: bool) -> str:
    """CTE ``s<k>``: the best split of each node of level ``k``; ``sums`` has the columns summed from the left."""
    names = sums.split(", ")
    left = ", ".join(f"sum({c}) OVER w AS l{c}, sum({c}) OVER o AS t{c}" for c in names)
    total = ", ".join(f"CAST(l{c} AS DOUBLE) AS l{c}, CAST(t{c} - l{c} AS DOUBLE) AS r{c}, CAST(t{c} AS DOUBLE) AS t{c}" for c in names)
    best = f"""
  SELECT node, place, cut, gain FROM (
    SELECT node, place, cut, {gain} AS gain FROM (
      SELECT node, place, cut, {total} FROM (
        SELECT node, place, v, {left} FROM h{k}
        WINDOW w AS (PARTITION BY node, place ORDER BY v), o AS (PARTITION BY node, place))
      JOIN {levels} USING (place, v) WHERE cut IS NOT NULL)
    WHERE {enough})
  WHERE gain > {least}
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, cut) = 1"""
    if key:
        # Best first: by the worst split on the way here, then by the worst one after that, and so on.
        own = "{'loss': -s.gain, 'node': s.node}"
        if k == 1:
            best = f"SELECT s.*, [{own}] AS key FROM ({best}) s"
        else:
            worse = "list_filter(p.key, lambda x: x.loss > -s.gain)"
            best = f"SELECT s.*, list_append({worse}, {own}) AS key FROM ({best}) s JOIN s{k - 1} p ON s.node // 2 = p.node"
    return f"\ns{k} AS MATERIALIZED ({best}\n)"


def _step(k: int, sign: str) -> str:
    """CTE ``n<k>``: every kind of rows one level further down."""
    return f"""
n{k} AS MATERIALIZED (
  SELECT n.* EXCLUDE (node), CASE WHEN cut IS NULL THEN n.node ELSE 2 * n.node + CASE WHEN {_VALUE} {sign} cut THEN 0 ELSE 1 END END AS node
  FROM n{k - 1} n LEFT JOIN s{k} s ON n.node = s.node
)"""


def _boosted(name: str, model: str, how: Boosting) -> str:
    """CTE ``grown_<name>_<model>`` with the forecast ``m`` of every row after ``tree`` rounds."""
    grow, own = how.growth, f"{name}_{model}"
    depth, l2 = grow.max_depth, repr(float(grow.l2))
    held = "side = 'train'" + ("" if how.subsample == 1 else f" AND {_hash()} < {math.floor(how.subsample * SAMPLE_PRIME)}")
    a, b, total = (f"({c}g / 65536.0::DOUBLE)" for c in "lrt")
    gain = f"{a} * {a} / (ln + {l2}) + {b} * {b} / (rn + {l2}) - ({total} * {total}) / (tn + {l2})"
    least = max(float(grow.min_rows), float(grow.min_weight))
    body = [f"""
n0 AS MATERIALIZED (
  SELECT k.*, places, g, n, 1 AS node FROM kinds_{name} k JOIN (
    SELECT kind, any_value(places) AS places, count(*) FILTER (held) AS n,
      coalesce(sum(CAST(floor((y - m) * 65536 + 0.5::DOUBLE) AS BIGINT)) FILTER (held), 0) AS g
    FROM (SELECT *, {held} AS held FROM grown_{own} JOIN trees_{own} USING (tree)) GROUP BY kind) USING (kind)
)"""]
    for k in range(1, depth + 1):
        body.append(f"""
h{k} AS MATERIALIZED (
  SELECT node, {_PLACE} AS place, coalesce({_NAMES}) AS v, sum(g) AS g, sum(n) AS n, any_value(places) AS places
  FROM n{k - 1} WHERE n > 0 AND node >= {2 ** (k - 1)} GROUP BY {_sets('node')}
  HAVING list_contains(any_value(places), {_PLACE})
)""")
        body.append(_split(k, f"levels_{name}", "g, n", gain, f"ln >= {least!r} AND rn >= {least!r}", repr(LEAST_GAIN), grow.max_leaves is not None))
        body.append(_step(k, "<"))
    if grow.max_leaves is None:
        body.append(f"\nends AS MATERIALIZED (SELECT kind, n, g, node FROM n{depth})")
    else:
        every = " UNION ALL ".join(f"SELECT node, key FROM s{k}" for k in range(1, depth + 1))
        body.append(f"""
chosen AS MATERIALIZED (SELECT node FROM ({every}) ORDER BY key LIMIT {grow.max_leaves - 1}),
leaf_of AS MATERIALIZED (
  SELECT f.node, min(f.node >> i) AS leaf FROM (SELECT DISTINCT node FROM n{depth}) f, range({depth + 1}) x(i)
  WHERE f.node >> i >= 1 AND NOT EXISTS (SELECT 1 FROM chosen WHERE chosen.node = f.node >> i) GROUP BY f.node
),
ends AS MATERIALIZED (SELECT kind, n, g, leaf AS node FROM n{depth} JOIN leaf_of USING (node))""")
    body.append(f"""
leaves AS MATERIALIZED (
  SELECT node, {how.learning_rate!r} * ((CAST(sum(g) AS DOUBLE) / 65536.0::DOUBLE) / (sum(n) + {l2})) AS value
  FROM ends WHERE n > 0 GROUP BY node
)""")
    return f"""
trees_{own}(tree, a, b, c, d, places) AS MATERIALIZED (VALUES {_factors(how.rounds, lambda t: sampled_columns(SEED, t, how.colsample, len(FEATURES)))}),
grown_{own} AS (
  SELECT all_{name}.*, 0 AS tree,
    (SELECT CAST(sum(CAST(floor(y * 65536 + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE) / 65536.0::DOUBLE / count(*)
     FROM all_{name} WHERE side = 'train') AS m
  FROM all_{name}
  UNION ALL
  (WITH {",".join(body).strip()}
  SELECT g.* EXCLUDE (tree, m), g.tree + 1 AS tree, g.m + value AS m
  FROM grown_{own} g JOIN (SELECT kind, value FROM ends JOIN leaves USING (node)) USING (kind))
)"""


def _forest(name: str) -> str:
    """CTE ``grown_<name>_forest_keyed`` with the sum ``m`` of what the first trees say of every row.

    Gains are written as MLlib works them out, since equal ones are frequent in small nodes.
    """
    p, own = MODEL_DEFAULTS["forest_keyed"], f"{name}_forest_keyed"
    n, depth, least = p["n_estimators"], p["max_depth"], p["min_samples_leaf"]

    def spread(c: str) -> str:
        return f"(({c}q - ({c}s * {c}s) / {c}w) / {c}w)"

    drawn = " + ".join(f"(h >= {b})::INT" for b in poisson_bounds())
    gain = f"{spread('t')} - (lw / (lw + rw)) * {spread('l')} - (rw / (lw + rw)) * {spread('r')}"
    body = [f"""
n0 AS MATERIALIZED (
  SELECT k.*, w, s, q, n, 1 AS node FROM kinds_{name} k JOIN (
    SELECT kind, sum(w) AS w, sum(w * y) AS s, sum(w * y * y) AS q, count(*) FILTER (w > 0) AS n
    FROM (SELECT kind, y, CASE WHEN side = 'train' THEN {drawn} ELSE 0 END AS w
          FROM (SELECT *, {_hash()} AS h FROM grown_{own} JOIN trees_{own} USING (tree))) GROUP BY kind) USING (kind)
)""", _levels("levels", "(SELECT * FROM n0 WHERE n > 0)")]  # fmt: skip
    for k in range(1, depth + 1):
        body.append(f"""
h{k} AS MATERIALIZED (
  SELECT node, {_PLACE} AS place, coalesce({_NAMES}) AS v, sum(w) AS w, sum(s) AS s, sum(q) AS q, sum(n) AS n
  FROM n{k - 1} WHERE n > 0 AND node >= {2 ** (k - 1)} GROUP BY {_sets('node')}
)""")
        body.append(_split(k, "levels", "w, s, q, n", gain, f"ln >= {least} AND rn >= {least}", "0", False))
        body.append(_step(k, "<="))
    body.append(f"\nleaves AS MATERIALIZED (SELECT node, sum(s) / sum(w) AS value FROM n{depth} WHERE n > 0 GROUP BY node)")
    return f"""
trees_{own}(tree, a, b, c, d, places) AS MATERIALIZED (VALUES {_factors(n)}),
grown_{own} AS (
  SELECT all_{name}.*, 0 AS tree, 0.0::DOUBLE AS m FROM all_{name}
  UNION ALL
  (WITH {",".join(body).strip()}
  SELECT g.* EXCLUDE (tree, m), g.tree + 1 AS tree, g.m + value AS m
  FROM grown_{own} g JOIN (SELECT kind, value FROM n{depth} JOIN leaves USING (node)) USING (kind))
)"""


MODELS = ("forest_keyed", *_HOW)


def forecasts(name: str) -> str:
    """CTEs with the forecasts of the models at their defaults on the split ``name``; see ``forecast_of``."""
    parts = [_rows(name), _levels(f"levels_{name}", f"(SELECT * FROM full_{name} WHERE side = 'train')"), _forest(name)]
    return ",".join(parts + [_boosted(name, model, how) for model, how in _HOW.items()])


def forecast_of(name: str, model: str) -> str:
    """Rows (y, m) of the test side with the forecast ``m`` of a model."""
    trees = MODEL_DEFAULTS[model]["n_estimators"]
    mean = f"m / {trees}" if model == "forest_keyed" else "m"
    return f"(SELECT y, {mean} AS m FROM grown_{name}_{model} WHERE tree = {trees} AND side = 'test')"
