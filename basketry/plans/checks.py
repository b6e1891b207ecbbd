"""The same queries in DuckDB SQL, written apart from the Spark code, one per catalog name."""

from __future__ import annotations

import json

from basketry.plans import ensemble_checks, tree_checks
from basketry.plans.catalog import (
    CLICK_EXPERIMENTS,
    ENSEMBLES,
    LINE_DATE,
    LINE_EXPERIMENT,
    LINEAR_WEIGHTS,
    SKETCH_DAYS,
    STUMP_LEAVES,
    STUMP_SPACES,
    TOP_DATE,
)
from basketry.plans.tree_checks import key_hash as _hash
from basketry.operators.tuning import draw_params
from basketry.settings import EVENT_COLUMNS, FEATURES, NA_TOKENS, SEARCH_FOLDS, TREE_MODELS

_DAY = "strftime({}, '%Y-%m-%d')"
_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


# -- shared inputs -------------------------------------------------------------------------

_CLICKS = """
clicks AS (
  SELECT event_id, event_time, event_type, k AS product_id, k % 10 AS category_id,
         'dept.' || (k % 10) AS category_code, 'brand-' || (user_id % 7) AS brand, price, user_id,
         user_id || '-' || strftime(event_time, '%Y%m%d') AS user_session
  FROM (SELECT event_id, ts AS event_time, value AS price, user_id,
               CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
                    ELSE event_type END AS event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events)
)"""

_SILVER = f"""{_CLICKS},
silver AS (
  SELECT *, CAST(event_time AS DATE) AS date FROM clicks
  WHERE event_type IN ('view', 'cart', 'remove_from_cart', 'purchase')
)"""

_LINES = """
silver AS (
  SELECT l_shipdate AS event_time,
         CASE l_returnflag WHEN 'R' THEN 'view' WHEN 'N' THEN 'cart' ELSE 'purchase' END
           AS event_type,
         l_partkey AS product_id, l_extendedprice / l_quantity AS price,
         CAST(l_shipdate AS DATE) AS date{user}
  FROM lineitem{join}
)"""
_LINE_SILVER = _LINES.format(user="", join="")
_LINE_SILVER_USER = _LINES.format(
    user=", o_custkey AS user_id", join=" JOIN orders ON l_orderkey = o_orderkey"
)

_COUNTS = """count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'cart') AS carts,
         count(*) FILTER (event_type = 'remove_from_cart') AS removals,
         count(*) FILTER (event_type = 'purchase') AS purchases"""

_DAILY = f"""
daily AS (
  SELECT product_id, date, {_COUNTS} FROM silver GROUP BY product_id, date
)"""


def _rolled(days: int, frame: str = "ROWS") -> str:
    order = "date" if frame == "ROWS" else "date - DATE '1970-01-01'"
    return ", ".join(
        f"CAST(sum({c}) OVER (PARTITION BY product_id ORDER BY {order} "
        f"{frame} BETWEEN {days - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS {c}_{days}d"
        for c in ("views", "carts", "purchases")
    )


_NEXT = "lead(purchases) OVER (PARTITION BY product_id ORDER BY date) AS purchases_next_day"
_GOLD = f"""{_DAILY},
gold AS (SELECT *, {_NEXT}, {_rolled(7)} FROM daily),
labelled AS (SELECT * FROM gold WHERE purchases_next_day IS NOT NULL)"""

_CLICK_GOLD = _SILVER + "," + _GOLD
_LINE_GOLD = _LINE_SILVER + "," + _GOLD


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query}"


_GOLD_COLUMNS = (
    "product_id, strftime(date, '%Y-%m-%d') AS date, views, carts, removals, purchases, "
    "purchases_next_day, views_7d, carts_7d, purchases_7d"
)


# -- cleaning ------------------------------------------------------------------------------

_DIRTY = f"""{_CLICKS},
spoiled AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 1 THEN 'bad-time' WHEN event_id % 101 = 1 THEN '10:00'
         WHEN event_id % 103 = 1 THEN '2019' WHEN event_id % 107 = 1 THEN 'NaN'
         WHEN event_id % 19 = 2 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
         WHEN event_id % 23 = 2 THEN strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')
         WHEN event_id % 29 = 2 THEN strftime(event_time, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
    CASE WHEN event_id % 89 = 1 THEN 'n/a'
         WHEN event_id % 5 = 2 THEN ' ' || chr(9) || upper(event_type) || ' '
         WHEN event_id % 83 = 1 THEN 'unknown' ELSE event_type END AS event_type,
    CASE WHEN event_id % 67 = 1 THEN product_id || '.5' WHEN event_id % 71 = 1 THEN '<NA>'
         WHEN event_id % 73 = 1 THEN 'x7' WHEN event_id % 79 = 1 THEN product_id || '.0'
         ELSE CAST(product_id AS VARCHAR) END AS product_id,
    CASE WHEN event_id % 7 = 3 THEN '2053013555631882655' WHEN event_id % 109 = 1 THEN '1e30'
         ELSE CAST(category_id AS VARCHAR) END AS category_id,
    CASE WHEN event_id % 11 = 1 THEN ' ' WHEN event_id % 13 = 1 THEN 'None '
         WHEN event_id % 17 = 1 THEN 'NULL' WHEN event_id % 6 = 1 THEN ' a.b '
         ELSE category_code END AS category_code,
    CASE WHEN event_id % 11 = 3 THEN '' WHEN event_id % 13 = 3 THEN ' nan'
         WHEN event_id % 17 = 3 THEN '#N/A' WHEN event_id % 6 = 3 THEN chr(9) || 'padded'
         ELSE brand END AS brand,
    CASE WHEN event_id % 31 = 1 THEN '-5.0' WHEN event_id % 37 = 1 THEN 'NaN'
         WHEN event_id % 41 = 1 THEN '1.0d' WHEN event_id % 43 = 1 THEN 'abc'
         WHEN event_id % 47 = 1 THEN '0' WHEN event_id % 53 = 1 THEN '1e2'
         WHEN event_id % 59 = 1 THEN ' 12.5 ' WHEN event_id % 61 = 1 THEN 'inf'
         ELSE CAST(price AS VARCHAR) END AS price,
    CASE WHEN event_id % 113 = 1 THEN 'null' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 14 = 1 THEN ' s ' WHEN event_id % 15 = 1 THEN 'None'
         ELSE user_session END AS user_session,
    CASE WHEN day(event_time) <= 15 THEN 'first-half' ELSE 'second-half' END AS source_file
  FROM clicks
),
dirty AS (
  SELECT * FROM spoiled
  UNION ALL SELECT * FROM spoiled WHERE event_id % 10 = 3
  UNION ALL SELECT * REPLACE (upper(event_type) || ' ' AS event_type,
                              'second-half' AS source_file)
            FROM spoiled WHERE event_id % 10 = 4
),
raw AS (
  SELECT event_id, source_file,
    {", ".join(f"CASE WHEN {c} NOT IN ({_quoted(NA_TOKENS)}) THEN {c} END AS {c}"
               for c in EVENT_COLUMNS)}
  FROM dirty
)"""

_BLANKS = "' ' || chr(9)"
_TIME = (
    "coalesce(try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC'), "
    "try_strptime(event_time, '%Y-%m-%d %H:%M:%S.%f'), "
    "try_strptime(event_time, '%Y-%m-%d %H:%M:%S'), "
    "try_strptime(event_time, '%Y-%m-%dT%H:%M:%SZ'))"
)
_TYPE = f"lower(trim(event_type, {_BLANKS}))"
_TYPES = "('view', 'cart', 'remove_from_cart', 'purchase')"


def _number(column: str) -> str:
    text = f"trim({column}, {_BLANKS})"
    pattern = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN try_cast({text} AS DOUBLE) END"


def _whole(column: str) -> str:
    text = f"trim({column}, {_BLANKS})"
    return (
        f"CASE WHEN regexp_full_match({text}, '[+-]?\\d+') THEN try_cast({text} AS BIGINT) "
        f"ELSE try_cast(trunc({_number(column)}) AS BIGINT) END"
    )


def _text(column: str) -> str:
    text = f"trim({column}, {_BLANKS})"
    return f"CASE WHEN {text} NOT IN ('', 'nan', 'None') THEN {text} END"


_NORMAL = f"""{_DIRTY},
typed AS (
  SELECT event_id, source_file, {_TIME} AS event_time, {_TYPE} AS event_type,
         {_whole("product_id")} AS product_id, {_whole("category_id")} AS category_id,
         {_text("category_code")} AS category_code, {_text("brand")} AS brand,
         {_number("price")} AS price, {_whole("user_id")} AS user_id,
         trim(user_session, {_BLANKS}) AS user_session
  FROM raw
),
normal AS (
  SELECT * FROM typed
  WHERE event_time IS NOT NULL AND event_type IN {_TYPES} AND price >= 0
    AND product_id IS NOT NULL AND category_id IS NOT NULL AND user_id IS NOT NULL
),
single AS (SELECT DISTINCT {", ".join(EVENT_COLUMNS)} FROM normal)"""

_EVENT_OUT = ", ".join(
    f"{_STAMP.format('event_time')} AS event_time" if c == "event_time" else c
    for c in EVENT_COLUMNS
)
_CLEAN_OUT = f"SELECT {_EVENT_OUT}, {_DAY.format('event_time')} AS date FROM single"

_SOURCE_NO = "CASE WHEN source_file = 'first-half' THEN 0 WHEN event_id % 2 = 0 THEN 1 ELSE 2 END"
_STATS = f"""{_NORMAL},
credited AS (
  SELECT min({_SOURCE_NO}) AS source_no FROM normal GROUP BY {", ".join(EVENT_COLUMNS)}
),
stats AS (
  SELECT source_no, ['first-half', 'second-half', 'second-half'][source_no + 1] AS source_file,
         rows_in, coalesce(rows_out, 0) AS rows_out
  FROM (SELECT {_SOURCE_NO} AS source_no, count(*) AS rows_in FROM raw GROUP BY 1)
  LEFT JOIN (SELECT source_no, count(*) AS rows_out FROM credited GROUP BY 1) USING (source_no)
)"""


# -- summary -------------------------------------------------------------------------------

_TOTALS = """SELECT product_id, count(*) FILTER (event_type = 'view') AS total_views,
    count(*) FILTER (event_type = 'cart') AS total_carts,
    count(*) FILTER (event_type = 'remove_from_cart') AS total_removals,
    count(*) FILTER (event_type = 'purchase') AS total_purchases
  FROM silver GROUP BY product_id"""
_RATES = """round(CAST(total_carts AS DOUBLE) / nullif(total_views, 0), 6) AS view_to_cart_rate,
  round(CAST(total_purchases AS DOUBLE) / nullif(total_carts, 0), 6) AS cart_to_purchase_rate"""
_UNIQUE = "count(DISTINCT user_id) FILTER (event_type = 'view')"
_PRICE = "round(avg(price) FILTER (event_type = 'purchase'), 6)"

_SUMMARY_PARTS = f"""
totals AS ({_TOTALS}),
seen AS (
  SELECT product_id, {_UNIQUE} AS unique_viewers, {_PRICE} AS avg_purchase_price
  FROM silver GROUP BY product_id
),
repeats AS (
  SELECT product_id, count(*) AS repeat_viewers
  FROM (SELECT product_id, user_id FROM silver WHERE event_type = 'view'
        GROUP BY 1, 2 HAVING count(*) > 1)
  GROUP BY product_id
),
peaks AS (
  SELECT product_id, CAST(hour AS INTEGER) AS peak_view_hour
  FROM (SELECT product_id, hour(event_time) AS hour,
               row_number() OVER (PARTITION BY product_id
                                  ORDER BY count(*) DESC, hour(event_time)) AS place
        FROM silver WHERE event_type = 'view' GROUP BY 1, 2)
  WHERE place = 1
)"""
_SUMMARY = f"""SELECT product_id, total_views, total_carts, total_removals, total_purchases,
  {_RATES}, unique_viewers, coalesce(repeat_viewers, 0) AS repeat_viewers, avg_purchase_price,
  peak_view_hour
FROM totals JOIN seen USING (product_id) LEFT JOIN repeats USING (product_id)
  LEFT JOIN peaks USING (product_id)"""


# -- splits, baselines, metrics ------------------------------------------------------------


def _dates(name: str, config: dict) -> str:
    """Two tables of days, ``train_<name>`` and ``test_<name>``."""
    days = "SELECT DISTINCT date FROM labelled"
    if "train_end" in config:
        return f"""
train_{name} AS ({days} WHERE date <= DATE '{config["train_end"]}'),
test_{name} AS ({days} WHERE date >= DATE '{config["test_start"]}'
  ORDER BY date LIMIT {config["test_days"]})"""
    both = config["train_days"] + config["test_days"]
    return f"""
train_{name} AS ({days} ORDER BY date LIMIT {config["train_days"]}),
test_{name} AS (SELECT date FROM ({days} ORDER BY date LIMIT {both})
  ORDER BY date OFFSET {config["train_days"]})"""


def _split(name: str, config: dict) -> str:
    return f"""{_dates(name, config)},
sides_{name} AS (
  SELECT *, 'train' AS side FROM labelled WHERE date IN (SELECT date FROM train_{name})
  UNION ALL
  SELECT *, 'test' AS side FROM labelled WHERE date IN (SELECT date FROM test_{name})
),
means_{name} AS (
  SELECT product_id, avg(purchases) AS mean FROM sides_{name} WHERE side = 'train'
  GROUP BY product_id
),
moving_{name} AS (
  SELECT *, avg(purchases) OVER (PARTITION BY product_id ORDER BY date
                                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7
  FROM sides_{name}
),
forecast_{name} AS (
  SELECT m.*, CAST(purchases_next_day AS DOUBLE) AS y, CAST(purchases AS DOUBLE) AS pred_lag1,
         ma7 AS pred_ma7, coalesce(mean, 0.0) AS pred_hist_mean
  FROM moving_{name} m LEFT JOIN means_{name} USING (product_id)
  WHERE side = 'test'
)"""


def _long(name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, {place} AS place, y, {column} AS p FROM forecast_{name}"
        for place, (model, column) in enumerate(
            (("lag1", "pred_lag1"), ("ma7", "pred_ma7"), ("hist_mean", "pred_hist_mean"))
        )
    )


def _stump(name: str, train: str, least: int) -> str:
    """CTE ``stump_<name>``: the split (feature, cut) and the two means of a tree of depth one.

    A cut lies halfway between two values that follow each other. The best one explains most of
    the variance of ``y``, that is, it has the largest sum of squared sums by size.
    """
    values = " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS f, coalesce(CAST({c} AS DOUBLE), 0) AS v, y FROM ({train})"
        for i, c in enumerate(FEATURES)
    )
    return f"""
points_{name} AS (
  SELECT place, f, v, count(*) AS n, sum(y) AS s FROM ({values}) GROUP BY ALL
),
cuts_{name} AS (
  SELECT place, f, (v + lead(v) OVER w) / 2 AS cut, sum(n) OVER w AS n, sum(s) OVER w AS s,
    sum(n) OVER (PARTITION BY f) AS all_n, sum(s) OVER (PARTITION BY f) AS all_s
  FROM points_{name} WINDOW w AS (PARTITION BY f ORDER BY v)
),
stump_{name} AS (
  SELECT f, cut, s / n AS below, (all_s - s) / (all_n - n) AS above
  FROM cuts_{name} WHERE cut IS NOT NULL AND n >= {least} AND all_n - n >= {least}
  ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC, place, cut LIMIT 1
)"""


def _stump_value(stump: str) -> str:
    """Forecast of a stump for the columns in scope."""
    fields = " ".join(f"WHEN '{c}' THEN coalesce(CAST({c} AS DOUBLE), 0)" for c in FEATURES)
    parts = {c: f"(SELECT {c} FROM stump_{stump})" for c in ("f", "cut", "below", "above")}
    return (
        f"CASE WHEN CASE {parts['f']} {fields} END <= {parts['cut']} "
        f"THEN {parts['below']} ELSE {parts['above']} END"
    )


def _train(name: str) -> str:
    return f"SELECT *, CAST(purchases_next_day AS DOUBLE) AS y FROM sides_{name} WHERE side = 'train'"


def _stumps(name: str, models=TREE_MODELS) -> str:
    """Stumps of the tree models on one split, and its forecasts with theirs added."""
    stumps = "," .join(_stump(f"{name}_{m}", _train(name), STUMP_LEAVES[m]) for m in models)
    columns = ", ".join(f"{_stump_value(f'{name}_{m}')} AS pred_{m}" for m in models)
    return f"{stumps},\ntrees_{name} AS (SELECT *, {columns} FROM forecast_{name})"


def _all_measured(name: str) -> str:
    """Measures of all six forecasts of one split."""
    long = " UNION ALL ".join(
        f"SELECT '{m}' AS model, {place} AS place, y, pred_{m} AS p FROM trees_{name}"
        for place, m in enumerate(("lag1", "ma7", "hist_mean", *TREE_MODELS))
    )
    return f"SELECT model, place, {_MEASURES} FROM ({long}) GROUP BY model, place"


_MEASURES = """count(*) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
  avg(abs(y - p) / abs(y)) FILTER (y <> 0) * 100 AS mape,
  CASE WHEN count(*) <= 1 THEN NULL
       WHEN min(y) = max(y) THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2"""
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("mae", "rmse", "mape", "r2"))


def _measured(name: str) -> str:
    return f"SELECT model, place, {_MEASURES} FROM ({_long(name)}) GROUP BY model, place"


def _sides(name: str) -> str:
    return (
        f"SELECT side, product_id, {_DAY.format('date')} AS date, purchases, purchases_next_day "
        f"FROM sides_{name}"
    )


_E1, _E2, _FINAL = (CLICK_EXPERIMENTS[e] for e in ("e1", "e2", "e_final"))
_ON_FINAL = f"{_CLICK_GOLD},{_split('f', _FINAL)}"
_ON_LINES = f"{_LINE_GOLD},{_split('l', LINE_EXPERIMENT)}"
_ON_ALL = f"{_CLICK_GOLD},{_split('e1', _E1)},{_split('e2', _E2)},{_split('e_final', _FINAL)}"

_RESULTS = " UNION ALL ".join(
    f"""SELECT '{e}' AS experiment, model, place, n, mae, rmse, mape, r2,
  (SELECT min(date) FROM train_{e}) AS train_first, (SELECT max(date) FROM train_{e}) AS train_last,
  (SELECT min(date) FROM test_{e}) AS test_first, (SELECT max(date) FROM test_{e}) AS test_last,
  (SELECT count(*) FROM sides_{e} WHERE side = 'train') AS train_rows,
  (SELECT count(*) FROM sides_{e} WHERE side = 'test') AS test_rows
FROM ({_measured(e)})"""
    for e in CLICK_EXPERIMENTS
)
_RANKED = f"""{_ON_ALL},
results AS ({_RESULTS}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY mae, place) = 1 AS is_best
  FROM results
)"""


def _folds(n_splits: int) -> str:
    return f"""
numbered AS (
  SELECT product_id, date, row_number() OVER (ORDER BY date, product_id) - 1 AS i,
         count(*) OVER () AS n
  FROM labelled
)
SELECT product_id, {_DAY.format("date")} AS date,
  CAST(CASE WHEN i < n - {n_splits} * (n // {n_splits + 1}) THEN -1
       ELSE (i - (n - {n_splits} * (n // {n_splits + 1}))) // (n // {n_splits + 1}) END AS INTEGER)
    AS test_fold
FROM numbered"""


_DATE_FOLDS = f"""
numbered AS (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT date FROM labelled)
)
SELECT product_id, {_DAY.format("date")} AS date,
  CAST(CASE WHEN i < n - 4 * (n // 5) THEN -1 ELSE (i - (n - 4 * (n // 5))) // (n // 5) END
       AS INTEGER) AS test_fold
FROM labelled JOIN numbered USING (date)"""


# -- attribution, scoring, residuals -------------------------------------------------------


_SCORE = " + ".join(f"{w} * CAST({c} AS DOUBLE)" for c, w in zip(FEATURES, LINEAR_WEIGHTS))
def _shapley(base: str, name: str) -> str:
    """Sample, background, and the closed form of a linear scorer's contributions."""
    means = ", ".join(f"avg({c}) AS mean_{c}" for c in FEATURES)
    phi = ", ".join(
        f"{w} * ({c} - mean_{c}) AS phi_{c}" for c, w in zip(FEATURES, LINEAR_WEIGHTS)
    )
    return f"""{base},
sample AS (
  SELECT * FROM sides_{name} WHERE side = 'test'
  ORDER BY {_hash(42)}, product_id, date LIMIT 5000
),
background AS (
  SELECT * FROM sides_{name} WHERE side = 'train'
  ORDER BY {_hash(43)}, product_id, date LIMIT 50
),
centre AS (SELECT {means}, avg({_SCORE}) AS base_value FROM background),
phi AS (SELECT product_id, date, base_value, {_SCORE} AS prediction, {phi} FROM sample, centre)"""


_SHAPLEY = _shapley(_ON_FINAL, "f")
_PHI_OUT = (
    f"SELECT product_id, {_DAY.format('date')} AS date, round(base_value, 6) AS base_value, "
    "round(prediction, 6) AS prediction, "
    + ", ".join(f"round(phi_{c}, 6) AS phi_{c}" for c in FEATURES)
    + " FROM phi"
)

_REQUESTS = """
requests AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 17 = 0 THEN -1 ELSE product_id END AS product_id,
         CASE WHEN event_id % 19 = 0 THEN '2024-1-5'
              ELSE strftime(event_time, '%Y-%m-%d') END AS date
  FROM clicks WHERE event_type = 'signup'
)"""

def _residuals(base: str, name: str) -> str:
    return f"""{base},
errors AS (SELECT y, pred_ma7 AS p, y - pred_ma7 AS r, views FROM forecast_{name})"""


_RESIDUALS, _LINE_RESIDUALS = _residuals(_ON_FINAL, "f"), _residuals(_ON_LINES, "l")


def _residual_summary(split: str) -> str:
    return (
        f"SELECT 'ma7' AS model_name, '{split}' AS split, count(*) AS n_test, "
        "round(avg(abs(r)), 6) AS mae, round(sqrt(avg(r * r)), 6) AS rmse, "
        "round(avg(r), 6) AS mean_residual FROM errors"
    )


def _histogram(base: str) -> str:
    return f"""WITH {base.strip()},
span AS (
  SELECT CASE WHEN min(r) = max(r) THEN min(r) - 0.5 ELSE min(r) END AS low,
         CASE WHEN min(r) = max(r) THEN max(r) + 0.5 ELSE max(r) END AS high
  FROM errors
),
bins AS (
  SELECT bin, CASE WHEN bin = 0 THEN low ELSE low + bin * ((high - low) / 80) END AS bin_start,
         CASE WHEN bin = 79 THEN high ELSE low + (bin + 1) * ((high - low) / 80) END AS bin_end
  FROM range(80) t(bin), span
)
SELECT bin, round(bin_start, 6) AS bin_start, round(bin_end, 6) AS bin_end,
  count(r) AS residuals
FROM bins LEFT JOIN errors
  ON r >= bin_start AND (r < bin_end OR (bin = 79 AND r <= bin_end))
GROUP BY bin, bin_start, bin_end"""


def _by_activity(base: str) -> str:
    return _with(
        f"""{base},
cuts AS (SELECT quantile_cont(CAST(views AS DOUBLE), 0.33::DOUBLE) AS q33,
                quantile_cont(CAST(views AS DOUBLE), 0.66::DOUBLE) AS q66 FROM errors)""",
        "SELECT CASE WHEN views <= q33 THEN 'low_views' WHEN views <= q66 THEN 'medium_views' "
        "ELSE 'high_views' END AS activity, count(*) AS n, round(avg(abs(r)), 6) AS mae "
        "FROM errors, cuts GROUP BY 1",
    )


def _fit(model: str) -> str:
    return _with(
        f"{_CLICK_GOLD},{_split('e1', _E1)},{_stumps('e1', (model,))}",
        f"SELECT product_id, {_DAY.format('date')} AS date, purchases_next_day, "
        f"round(pred_{model}, 6) AS prediction FROM trees_e1",
    )


_RUN = f"{_ON_ALL},{_stumps('e1')},{_stumps('e2')},{_stumps('e_final')}"
_RUN_RESULTS = " UNION ALL ".join(
    f"""SELECT '{e}' AS experiment, *,
  (SELECT count(*) FROM sides_{e} WHERE side = 'train') AS train_rows,
  (SELECT count(*) FROM sides_{e} WHERE side = 'test') AS test_rows FROM ({_all_measured(e)})"""
    for e in CLICK_EXPERIMENTS
)


def _run_experiments() -> str:
    return _with(
        f"""{_RUN},
results AS ({_RUN_RESULTS})""",
        f"SELECT experiment, model, {_ROUNDED}, train_rows, test_rows, row_number() OVER "
        "(PARTITION BY experiment ORDER BY results.mae, place) = 1 AS is_best FROM results",
    )


def _analysis_run() -> str:
    """The best tree of e_final on its test window."""
    served = " ".join(f"WHEN '{m}' THEN pred_{m}" for m in TREE_MODELS)
    trees = ", ".join(f"'{m}'" for m in TREE_MODELS)
    return _with(
        f"""{_ON_ALL},{_stumps('e_final')},
served AS (
  SELECT model FROM ({_all_measured("e_final")}) WHERE model IN ({trees}) ORDER BY mae, place LIMIT 1
),
errors AS (
  SELECT y - CASE (SELECT model FROM served) {served} END AS r, views FROM trees_e_final
),
cuts AS (SELECT quantile_cont(CAST(views AS DOUBLE), 0.33::DOUBLE) AS q33,
                quantile_cont(CAST(views AS DOUBLE), 0.66::DOUBLE) AS q66 FROM errors)""",
        "SELECT (SELECT model FROM served) AS model_name, 'e_final' AS split, count(*) AS n_test, "
        "round(avg(abs(r)), 6) AS mae, round(sqrt(avg(r * r)), 6) AS rmse, "
        "round(avg(r), 6) AS mean_residual, "
        "round(avg(abs(r)) FILTER (views <= q33), 6) AS low_views, "
        "round(avg(abs(r)) FILTER (views > q33 AND views <= q66), 6) AS medium_views, "
        "round(avg(abs(r)) FILTER (views > q66), 6) AS high_views, "
        "count(*) AS in_histogram, CAST(1 AS BIGINT) AS log_rows FROM errors, cuts",
    )


_LEAF_PARAMETER = {"random_forest": "min_samples_leaf", "gbt_leafcap": "min_child_samples"}


def _search() -> str:
    """Every trial of the search: draws, fold errors of the stump, their mean, the best."""
    start = f"n - {SEARCH_FOLDS} * (n // {SEARCH_FOLDS + 1})"
    size = f"(n // {SEARCH_FOLDS + 1})"
    trials = [
        (m, i, params, params.get(_LEAF_PARAMETER.get(m), 1))
        for m, space in STUMP_SPACES.items()
        for i, params in enumerate(draw_params(space, 2))
    ]
    leaves = sorted({t[3] for t in trials})
    stumps, errors = [], []
    for leaf in leaves:
        for fold in range(SEARCH_FOLDS):
            train = f"SELECT * FROM places WHERE i < {start} + {fold} * {size}"
            stumps.append(_stump(f"t{leaf}_{fold}", train, leaf))
            errors.append(
                f"SELECT {leaf} AS leaf, avg(abs(y - {_stump_value(f't{leaf}_{fold}')})) AS mae "
                f"FROM places WHERE i >= {start} + {fold} * {size} AND i < {start} + {fold + 1} * {size}"
            )
    listed = ", ".join(
        f"('{m}', {i}, '{json.dumps(params, sort_keys=True)}', {leaf})" for m, i, params, leaf in trials
    )
    return f"""{_ON_FINAL},
places AS (
  SELECT *, CAST(purchases_next_day AS DOUBLE) AS y,
    row_number() OVER (ORDER BY date, product_id) - 1 AS i, count(*) OVER () AS n
  FROM sides_f WHERE side = 'train'
),{",".join(stumps)},
means AS (SELECT leaf, avg(mae) AS cv FROM ({" UNION ALL ".join(errors)}) GROUP BY leaf),
trials AS (
  SELECT t.model, t.trial, t.params, cv,
    row_number() OVER (PARTITION BY t.model ORDER BY round(cv, 12), t.trial) = 1 AS is_best
  FROM (VALUES {listed}) t(model, trial, params, leaf) JOIN means USING (leaf)
)"""


_STUMP_ON_FINAL = f"{_ON_FINAL},{_stumps('f', ('random_forest',))}"


def _stump_shapley() -> str:
    """A stump looks at one feature, which gets the whole difference to the mean forecast."""
    value = _stump_value("f_random_forest")
    phi = ", ".join(
        f"round(CASE WHEN (SELECT f FROM stump_f_random_forest) = '{c}' "
        f"THEN p - base_value ELSE 0 END, 6) AS phi_{c}"
        for c in FEATURES
    )
    return _with(
        f"""{_STUMP_ON_FINAL},
sample AS (
  SELECT *, {value} AS p FROM (SELECT * FROM sides_f WHERE side = 'test'
  ORDER BY {_hash(42)}, product_id, date LIMIT 5000)
),
centre AS (
  SELECT avg({value}) AS base_value FROM (SELECT * FROM sides_f WHERE side = 'train'
  ORDER BY {_hash(43)}, product_id, date LIMIT 50)
)""",
        f"SELECT product_id, {_DAY.format('date')} AS date, round(base_value, 6) AS base_value, "
        f"round(p, 6) AS prediction, {phi} FROM sample, centre",
    )


def _stump_lookup() -> str:
    value = _stump_value("f_random_forest")
    return _with(
        f"""{_STUMP_ON_FINAL},{_REQUESTS},
scored AS (SELECT product_id, strftime(date, '%Y-%m-%d') AS date, purchases_next_day, {value} AS p
           FROM gold)""",
        "SELECT request_id, r.product_id, r.date, "
        "round(coalesce(p, 0), 6) AS predicted_purchases_next_day, "
        "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
        "round(p - purchases_next_day, 6) AS prediction_error, 'random_forest' AS model_used, "
        "CASE WHEN p IS NULL THEN 'no data for this product/date combination' END AS note "
        "FROM requests r LEFT JOIN scored g ON r.product_id = g.product_id AND r.date = g.date",
    )


def _stump_top() -> str:
    value = _stump_value("f_random_forest")
    return _with(
        f"""{_STUMP_ON_FINAL},
scored AS (SELECT *, {value} AS p FROM gold WHERE gold.date = DATE '{TOP_DATE}')""",
        f"SELECT '{TOP_DATE}' AS date, CAST(row_number() OVER (ORDER BY p DESC, product_id) "
        "AS INTEGER) AS rank, product_id, round(p, 6) AS predicted_purchases_next_day, "
        "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
        "round(p - purchases_next_day, 6) AS prediction_error, "
        "CAST(purchases AS DOUBLE) AS purchases, CAST(views AS DOUBLE) AS views, "
        "'random_forest' AS model_used FROM scored ORDER BY rank LIMIT 10",
    )


_STATUS_CASES = (
    (TOP_DATE, f"DATE '{TOP_DATE}'", 0.0),
    (TOP_DATE, f"DATE '{TOP_DATE}'", 1e9),
    ("2099-01-01", "DATE '2099-01-01'", 0.0),
    ("soon", "NULL", 0.0),
)


def _status(asked: str, day: str, views: float) -> str:
    return f"""SELECT '{asked}' AS date, count(*) FILTER (date = {day}) AS rows_on_date,
  count(*) FILTER (date = {day} AND views >= {views:.1f}) AS rows_kept,
  CASE WHEN count(*) FILTER (date = {day}) = 0
       THEN 'no gold rows for date {asked}'
       WHEN count(*) FILTER (date = {day} AND views >= {views:.1f}) = 0
       THEN 'no products with views >= {views} on {asked}' END AS note,
  strftime(min(date), '%Y-%m-%d') AS min_date, strftime(max(date), '%Y-%m-%d') AS max_date
FROM gold"""


def _top_viewed() -> str:
    return (
        "SELECT product_id, count(*) AS views FROM silver WHERE event_type = 'view' "
        "GROUP BY product_id ORDER BY views DESC, product_id LIMIT 20"
    )


_TOP_PRODUCTS = (
    "SELECT product_id, CAST(sum(purchases) AS BIGINT) AS total_purchases FROM gold "
    "GROUP BY product_id ORDER BY total_purchases DESC, product_id LIMIT 20"
)

_CALENDAR = f"""
SELECT product_id, strftime(date, '%Y-%m-%d') AS date, views, carts, removals, purchases,
  CASE WHEN NOT EXISTS (SELECT 1 FROM daily l WHERE l.product_id = d.product_id AND l.date > d.date)
       THEN NULL
       ELSE coalesce((SELECT t.purchases FROM daily t
                      WHERE t.product_id = d.product_id AND t.date = d.date + 1), 0) END
    AS purchases_next_day,
  {_rolled(7, "RANGE")}
FROM daily d"""

_EDA = f"""
SELECT (SELECT count(*) FROM silver) AS rows,
  (SELECT strftime(min(event_time), '%Y-%m-%d %H:%M:%S') FROM silver) AS date_min,
  (SELECT strftime(max(event_time), '%Y-%m-%d %H:%M:%S') FROM silver) AS date_max,
  (SELECT count(DISTINCT product_id) FROM silver) AS unique_products,
  (SELECT count(DISTINCT user_id) FROM silver) AS unique_users,
  (SELECT count(*) FROM silver WHERE event_type = 'view') AS n_view,
  (SELECT count(*) FROM silver WHERE event_type = 'cart') AS n_cart,
  (SELECT count(*) FROM silver WHERE event_type = 'remove_from_cart') AS n_remove,
  (SELECT count(*) FROM silver WHERE event_type = 'purchase') AS n_purchase,
  (SELECT count(*) FROM silver WHERE event_type = 'purchase') AS counted_purchase,
  (SELECT string_agg(product_id || ':' || views, ',' ORDER BY views DESC, product_id)
   FROM ({_top_viewed()})) AS top_viewed"""


def _fit_ensemble(model: str) -> str:
    return _with(
        f"{_CLICK_GOLD},{_split('e1', _E1)},{tree_checks.forecasts('e1', (model,))}",
        f"SELECT product_id, {_DAY.format('date')} AS date, CAST(y AS BIGINT) AS purchases_next_day, "
        f"round(m, 6) AS prediction FROM {tree_checks.forecast_of('e1', model)} WHERE side = 'test'",
    )


def _evaluate_ensembles(base: str, name: str) -> str:
    long = " UNION ALL ".join(
        [f"SELECT model, y, p FROM ({_long(name)})"]
        + [
            f"SELECT '{m}' AS model, y, m AS p FROM {tree_checks.forecast_of(name, m)} WHERE side = 'test'"
            for m in ENSEMBLES
        ]
    )
    return _with(
        f"{base},{tree_checks.forecasts(name)}",
        f"SELECT model, n, {_ROUNDED} FROM (SELECT model, {_MEASURES} FROM ({long}) GROUP BY model)",
    )


def _evaluate_ensembles_at_defaults(base: str, name: str) -> str:
    long = " UNION ALL ".join(
        [f"SELECT model, y, p FROM ({_long(name)})"]
        + [f"SELECT '{m}' AS model, y, m AS p FROM {ensemble_checks.forecast_of(name, m)}" for m in ensemble_checks.MODELS]
    )
    found = f"SELECT model, n, {_ROUNDED} FROM (SELECT model, {_MEASURES} FROM ({long}) GROUP BY model)"
    return _with(f"{base},{ensemble_checks.forecasts(name)}", found).replace("WITH", "WITH RECURSIVE", 1)


def _tree_attribution() -> str:
    chosen = f"""
chosen AS (
  SELECT * FROM rows_f WHERE side = 'test' ORDER BY {_hash(42)}, product_id, date LIMIT 5000
)"""
    trees = tree_checks.forecasts("f", ("gbt_second_order",))
    # what rounds to nothing is written without a sign
    phi = ", ".join(f"CASE WHEN abs(phi_{c}) < 5e-7 THEN 0.0::DOUBLE ELSE round(phi_{c}, 6) END AS phi_{c}" for c in FEATURES)
    return _with(
        f"{_ON_FINAL},{trees},{chosen},{tree_checks.contributions('f', 'chosen')}",
        f"SELECT product_id, {_DAY.format('date')} AS date, round(base_value, 6) AS base_value, "
        f"round(prediction, 6) AS prediction, {phi} FROM phi",
    )


def oracle_sql() -> dict[str, str]:
    raw_out = f"SELECT event_id, {', '.join(EVENT_COLUMNS)} FROM raw"
    day = f"{_DAY.format('date')} AS date"
    found = {
        "bronze_scan": _with(_DIRTY, f"SELECT {', '.join(EVENT_COLUMNS)}, source_file FROM raw"),
        "bronze_limit": _with(
            _DIRTY,
            "SELECT event_id, CAST(event_id % 8 AS INTEGER) AS source_no FROM (SELECT event_id, "
            "row_number() OVER (PARTITION BY event_id % 8 ORDER BY event_id) AS place FROM dirty) "
            "WHERE place <= 50",
        ),
        "silver_roundtrip": _with(_NORMAL, _CLEAN_OUT),
        "gold_roundtrip": _with(
            _CLICK_GOLD,
            f"SELECT {_GOLD_COLUMNS}, strftime(date, '%Y-%m-%d') AS date_str FROM gold",
        ),
        "run_log": _with(
            f"{_STATS},{_SILVER.removeprefix(_CLICKS + ',')},{_DAILY}",
            "SELECT 'clean' AS stage, CAST(source_no AS BIGINT) AS source_no, source_file, rows_in, "
            "rows_out, CAST(NULL AS BIGINT) AS product_by_day_rows FROM stats UNION ALL "
            "SELECT 'build_features', NULL, NULL, NULL, NULL, count(*) FROM daily",
        ),
        "experiment_results": _with(
            _RANKED,
            f"SELECT experiment, false AS tuned, model, {_ROUNDED}, "
            + ", ".join(
                f"{_DAY.format(c)} AS {c}"
                for c in ("train_first", "train_last", "test_first", "test_last")
            )
            + ", train_rows, test_rows, is_best FROM ranked",
        ),
        "na_tokens": _with(_DIRTY, raw_out),
        "clean_time": _with(
            _NORMAL,
            f"SELECT event_id, {_STAMP.format('event_time')} AS event_time FROM typed "
            "WHERE event_time IS NOT NULL",
        ),
        "clean_event_type": _with(
            _NORMAL, f"SELECT event_id, event_type FROM typed WHERE event_type IN {_TYPES}"
        ),
        "clean_price": _with(
            _NORMAL, "SELECT event_id, round(price, 6) AS price FROM typed WHERE price >= 0"
        ),
        "clean_ids": _with(
            _NORMAL,
            "SELECT event_id, product_id, category_id, user_id FROM typed WHERE product_id "
            "IS NOT NULL AND category_id IS NOT NULL AND user_id IS NOT NULL",
        ),
        "clean_text": _with(
            _NORMAL, "SELECT event_id, category_code, brand, user_session FROM typed"
        ),
        "clean_dedup": _with(_NORMAL, f"SELECT {_EVENT_OUT} FROM single"),
        "clean_all": _with(_NORMAL, _CLEAN_OUT),
        "clean_stats": _with(_STATS, "SELECT source_no, source_file, rows_in, rows_out FROM stats"),
        "streaming_dedup": _with(_NORMAL, _CLEAN_OUT),
        "streaming_product_days": _with(
            _CLICK_GOLD,
            f"SELECT {_GOLD_COLUMNS} FROM (SELECT *, lead(date) OVER (PARTITION BY product_id "
            "ORDER BY date) AS following FROM gold) "
            "WHERE following + INTERVAL 1 DAY <= (SELECT max(event_time) FROM silver) - INTERVAL 2 DAY",
        ),
        "unique_viewers_sketch": _with(
            _SILVER,
            "SELECT product_id, count(DISTINCT user_id) AS unique_viewers, true AS within_3_percent FROM silver "
            f"WHERE event_type = 'view' AND date BETWEEN DATE '{SKETCH_DAYS[0]}' AND DATE '{SKETCH_DAYS[1]}' "
            "GROUP BY product_id",
        ),
        "activity_sketch": _with(
            _ON_LINES,
            "SELECT side = 'test' AS is_test, count(*) AS n, true AS within_1_percent FROM sides_l GROUP BY side",
        ),
        "streaming_ingest": _with(_NORMAL, _CLEAN_OUT),
        "product_counts": _with(_SILVER, _TOTALS),
        "product_rates": _with(
            f"{_SILVER}, totals AS ({_TOTALS})", f"SELECT product_id, {_RATES} FROM totals"
        ),
        "unique_viewers": _with(
            _SILVER,
            f"SELECT product_id, {_UNIQUE} AS unique_viewers FROM silver GROUP BY product_id",
        ),
        "repeat_viewers": _with(
            f"{_SILVER},{_SUMMARY_PARTS}",
            "SELECT product_id, coalesce(repeat_viewers, 0) AS repeat_viewers "
            "FROM totals LEFT JOIN repeats USING (product_id)",
        ),
        "avg_purchase_price": _with(
            _SILVER,
            f"SELECT product_id, {_PRICE} AS avg_purchase_price FROM silver GROUP BY product_id",
        ),
        "peak_view_hour": _with(
            f"{_SILVER},{_SUMMARY_PARTS}",
            "SELECT product_id, peak_view_hour FROM totals LEFT JOIN peaks USING (product_id)",
        ),
        "product_summary": _with(f"{_SILVER},{_SUMMARY_PARTS}", _SUMMARY),
        "product_summary_lineitem": _with(f"{_LINE_SILVER_USER},{_SUMMARY_PARTS}", _SUMMARY),
        "product_day_counts": _with(
            f"{_SILVER},{_DAILY}",
            f"SELECT product_id, {day}, views, carts, removals, purchases FROM daily",
        ),
        "product_day_counts_extra": _with(
            _CLICKS,
            f"SELECT product_id, {_DAY.format('event_time')} AS date, {_COUNTS}, "
            "count(*) FILTER (event_type = 'signup') AS signup FROM clicks GROUP BY 1, 2",
        ),
        "next_day_target": _with(
            _CLICK_GOLD,
            f"SELECT product_id, {day}, views, carts, removals, purchases, purchases_next_day "
            "FROM gold",
        ),
        "rolling_features": _with(
            _CLICK_GOLD,
            f"SELECT product_id, {day}, views, carts, removals, purchases, views_7d, carts_7d, "
            "purchases_7d FROM gold",
        ),
        "rolling_features_3d": _with(
            f"{_SILVER},{_DAILY}",
            f"SELECT * REPLACE ({_DAY.format('date')} AS date) FROM "
            f"(SELECT *, {_rolled(3)} FROM daily)",
        ),
        "product_by_day": _with(_CLICK_GOLD, f"SELECT {_GOLD_COLUMNS} FROM gold"),
        "product_by_day_lineitem": _with(_LINE_GOLD, f"SELECT {_GOLD_COLUMNS} FROM gold"),
        "product_by_day_calendar": _with(f"{_SILVER},{_DAILY}", _CALENDAR),
        "product_by_day_calendar_lineitem": _with(f"{_LINE_SILVER},{_DAILY}", _CALENDAR),
        "eda_summary": _with(_SILVER, _EDA),
        "event_funnel": _with(
            _SILVER,
            "SELECT CAST(step AS INTEGER) AS step, f.event_type, count(s.event_type) AS events "
            "FROM (VALUES (1, 'view'), (2, 'cart'), (3, 'remove_from_cart'), (4, 'purchase')) "
            "f(step, event_type) LEFT JOIN silver s USING (event_type) GROUP BY 1, 2",
        ),
        "daily_volume": _with(
            _SILVER, f"SELECT {day}, count(*) AS events FROM silver GROUP BY 1"
        ),
        "daily_volume_lineitem": _with(
            _LINE_SILVER, f"SELECT {day}, count(*) AS events FROM silver GROUP BY 1"
        ),
        "hourly_volume": _with(
            _SILVER,
            "SELECT CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS events FROM silver "
            "GROUP BY 1",
        ),
        "top_viewed": _with(_SILVER, _top_viewed()),
        "top_viewed_lineitem": _with(_LINE_SILVER, _top_viewed()),
        "split_calendar": _with(
            _CLICK_GOLD,
            f"SELECT {day}, count(*) AS rows, count(purchases_next_day) AS labelled_rows "
            "FROM gold GROUP BY 1",
        ),
        "split_first_n": _with(f"{_CLICK_GOLD},{_split('e1', _E1)}", _sides("e1")),
        "split_boundary": _with(f"{_CLICK_GOLD},{_split('e2', _E2)}", _sides("e2")),
        "split_boundary_purged": _with(
            f"""{_ON_FINAL},
dated AS (SELECT product_id, date,
                 lead(date) OVER (PARTITION BY product_id ORDER BY date) AS label_date
          FROM gold)""",
            f"SELECT side, s.product_id, strftime(s.date, '%Y-%m-%d') AS date, purchases, "
            "purchases_next_day FROM sides_f"
            " s JOIN dated USING (product_id, date) WHERE side = 'test' OR label_date < "
            "(SELECT min(date) FROM test_f)",
        ),
        "ts_folds": f"WITH {_CLICK_GOLD.strip()},{_folds(3)}",
        "ts_folds_lineitem": f"WITH {_LINE_GOLD.strip()},{_folds(3)}",
        "ts_folds_by_date": f"WITH {_CLICK_GOLD.strip()},{_DATE_FOLDS}",
        "baseline_lag1": _with(
            _CLICK_GOLD, f"SELECT product_id, {day}, purchases AS pred_lag1 FROM gold"
        ),
        "baseline_ma7": _with(
            _CLICK_GOLD,
            f"SELECT product_id, {day}, round(avg(purchases) OVER (PARTITION BY product_id "
            "ORDER BY gold.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS pred_ma7 "
            "FROM gold",
        ),
        "baseline_on_split": _with(
            f"{_CLICK_GOLD},{_split('e2', _E2)}",
            f"SELECT product_id, {day}, y, pred_lag1, round(pred_ma7, 6) AS pred_ma7, "
            "round(pred_hist_mean, 6) AS pred_hist_mean FROM forecast_e2",
        ),
        "hist_mean": _with(
            _ON_LINES,
            f"SELECT product_id, {day}, round(pred_hist_mean, 6) AS pred_hist_mean "
            "FROM forecast_l",
        ),
        "metrics_baselines": _with(
            f"{_CLICK_GOLD},{_split('e1', _E1)}",
            f"SELECT 'pred_' || model AS model, n, {_ROUNDED} FROM ({_measured('e1')})",
        ),
        "evaluate_baselines": _with(
            _ON_FINAL, f"SELECT model, n, {_ROUNDED} FROM ({_measured('f')})"
        ),
        "evaluate_baselines_lineitem": _with(
            _ON_LINES, f"SELECT model, n, {_ROUNDED} FROM ({_measured('l')})"
        ),
        "best_model": _with(
            _RANKED, "SELECT experiment, model, round(mae, 6) AS mae FROM ranked WHERE is_best"
        ),
        "attribution_sample": _with(
            _ON_LINES,
            f"SELECT product_id, {day}, {', '.join(FEATURES)} FROM (SELECT * FROM sides_l "
            f"WHERE side = 'test' ORDER BY {_hash(42)}, product_id, date LIMIT 5000)",
        ),
        "feature_attribution": _with(_SHAPLEY, _PHI_OUT),
        "feature_attribution_lineitem": _with(_shapley(_ON_LINES, "l"), _PHI_OUT),
        "feature_attribution_ranking": _with(
            _SHAPLEY,
            " UNION ALL ".join(
                f"SELECT '{c}' AS feature, round(avg(abs(phi_{c})), 6) AS mean_abs FROM phi"
                for c in FEATURES
            ),
        ),
        "feature_attribution_model": _stump_shapley(),
        "fit_random_forest": _fit("random_forest"),
        "fit_gbt_depthwise": _fit("gbt_depthwise"),
        "fit_gbt_leafcap": _fit("gbt_leafcap"),
        **{f"fit_{m}": _fit_ensemble(m) for m in ENSEMBLES},
        "evaluate_ensembles": _evaluate_ensembles(f"{_CLICK_GOLD},{_split('e1', _E1)}", "e1"),
        "evaluate_ensembles_lineitem": _evaluate_ensembles_at_defaults(_ON_LINES, "l"),
        "tree_attribution": _tree_attribution(),
        "evaluate_models": _with(
            f"{_CLICK_GOLD},{_split('e1', _E1)},{_stumps('e1')}",
            f"SELECT model, n, {_ROUNDED} FROM ({_all_measured('e1')})",
        ),
        "evaluate_models_lineitem": _with(
            f"{_ON_LINES},{_stumps('l')}",
            f"SELECT model, n, {_ROUNDED} FROM ({_all_measured('l')})",
        ),
        "run_experiments": _run_experiments(),
        "analysis_run": _analysis_run(),
        "best_params_roundtrip": _with(_search(), "SELECT model, params FROM trials WHERE is_best"),
        "predict_lookup_model": _stump_lookup(),
        "top_predicted_model": _stump_top(),
        "model_roundtrip": _with(
            _STUMP_ON_FINAL,
            f"SELECT product_id, {day}, round(pred_random_forest, 6) AS prediction, "
            "round(mean, 6) AS mean FROM trees_f LEFT JOIN means_f USING (product_id)",
        ),
        "predict_lookup": _with(
            f"{_CLICK_GOLD},{_REQUESTS}",
            "SELECT request_id, r.product_id, r.date, "
            "CAST(coalesce(purchases, 0) AS DOUBLE) AS predicted_purchases_next_day, "
            "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
            "CAST(purchases - purchases_next_day AS DOUBLE) AS prediction_error, "
            "'lag1' AS model_used, CASE WHEN g.product_id IS NULL THEN "
            "'no data for this product/date combination' END AS note, "
            + ", ".join(f"CAST({c} AS DOUBLE) AS used_{c}" for c in FEATURES)
            + " FROM requests r LEFT JOIN gold g ON r.product_id = g.product_id "
            "AND r.date = strftime(g.date, '%Y-%m-%d')",
        ),
        "predict_lookup_lineitem": _with(
            f"""{_LINE_GOLD},
asked AS (SELECT product_id, date - 1 AS day FROM silver)""",
            f"SELECT a.product_id, {_DAY.format('a.day')} AS date, "
            "CAST(coalesce(purchases, 0) AS DOUBLE) AS predicted_purchases_next_day, "
            "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
            "CAST(purchases - purchases_next_day AS DOUBLE) AS prediction_error, "
            "'lag1' AS model_used, CASE WHEN g.product_id IS NULL THEN "
            "'no data for this product/date combination' END AS note "
            "FROM asked a LEFT JOIN gold g ON a.product_id = g.product_id AND a.day = g.date",
        ),
        "top_products": _with(_CLICK_GOLD, _TOP_PRODUCTS),
        "top_products_lineitem": _with(_LINE_GOLD, _TOP_PRODUCTS),
        "gold_date_range": _with(
            _CLICK_GOLD,
            f"SELECT {_DAY.format('min(date)')} AS min_date, "
            f"{_DAY.format('max(date)')} AS max_date FROM gold",
        ),
        "top_predicted_baseline": _with(
            _CLICK_GOLD,
            f"SELECT '{TOP_DATE}' AS date, CAST(row_number() OVER (ORDER BY purchases DESC, "
            "product_id) AS INTEGER) AS rank, product_id, "
            "CAST(purchases AS DOUBLE) AS predicted_purchases_next_day, "
            "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
            "CAST(purchases - purchases_next_day AS DOUBLE) AS prediction_error, "
            "CAST(purchases AS DOUBLE) AS purchases, CAST(views AS DOUBLE) AS views, "
            f"'lag1' AS model_used FROM gold WHERE gold.date = DATE '{TOP_DATE}' "
            "AND gold.views >= 1 ORDER BY rank LIMIT 25",
        ),
        "top_predicted_lineitem": _with(
            f"""{_LINE_GOLD},
scored AS (SELECT *, {_SCORE} AS p FROM gold WHERE gold.date = DATE '{LINE_DATE}')""",
            f"SELECT '{LINE_DATE}' AS date, CAST(row_number() OVER (ORDER BY p DESC, "
            "product_id) AS INTEGER) AS rank, product_id, "
            "round(p, 6) AS predicted_purchases_next_day, "
            "CAST(purchases_next_day AS DOUBLE) AS actual_purchases_next_day, "
            "round(p - purchases_next_day, 6) AS prediction_error, "
            "CAST(purchases AS DOUBLE) AS purchases, CAST(views AS DOUBLE) AS views, "
            "'linear' AS model_used FROM scored ORDER BY rank LIMIT 100",
        ),
        "top_predicted_status": _with(
            _CLICK_GOLD, " UNION ALL ".join(_status(*case) for case in _STATUS_CASES)
        ),
        "residual_summary": _with(_RESIDUALS, _residual_summary("e_final")),
        "residual_summary_lineitem": _with(_LINE_RESIDUALS, _residual_summary("boundary")),
        "residual_histogram": _histogram(_RESIDUALS),
        "residual_histogram_lineitem": _histogram(_LINE_RESIDUALS),
        "error_by_activity": _by_activity(_RESIDUALS),
        "error_by_activity_lineitem": _by_activity(_LINE_RESIDUALS),
        "pred_vs_actual": _with(
            _RESIDUALS, "SELECT 'ma7' AS model_name, y, round(p, 6) AS y_hat FROM errors"
        ),
        "experiment_comparison": _with(
            _RANKED,
            "SELECT model, "
            + ", ".join(
                f"round(max(mae) FILTER (experiment = '{e}'), 6) AS {e}" for e in CLICK_EXPERIMENTS
            )
            + ", CAST(NULL AS DOUBLE) AS e_final_tuned FROM ranked GROUP BY model",
        ),
    }
    # the same rows from gold in buckets
    found["baseline_on_buckets"] = found["baseline_on_split"]
    found["predict_lookup_on_buckets"] = found["predict_lookup"]
    return found
