"""Reference SQL for the registered queries, over the same tables, for an independent SQL engine.

Every statement starts from the base tables.  Numbers are rounded to six places and dates rendered as
text, as the queries do, with the same shift of the rounding border; adding 0e0 turns a negative zero
into zero.
"""

from demandspark.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS, RAW_COLUMNS

KEY = ("date", "store_id", "sku_id")

ORACLES: dict[str, str] = {}


def num(expression: str, name: str | None = None) -> str:
    return f"round({expression} + 1e-9, 6) + 0e0 AS {name or expression}"


def nums(*names: str) -> str:
    return ", ".join(num(n) for n in names)


def day(expression: str = "date", name: str | None = None) -> str:
    return f"strftime({expression}, '%Y-%m-%d') AS {name or expression}"


KEYS = f"{day()}, store_id, sku_id"

RAW = """
raw AS (
  SELECT cast(l_shipdate AS date) AS date,
         concat('store_', lpad(cast(n_regionkey AS varchar), 2, '0')) AS store_id,
         p_brand AS sku_id,
         CASE cast(substr(p_brand, 7) AS int) % 4
           WHEN 0 THEN 'grocery' WHEN 1 THEN 'home' WHEN 2 THEN 'personal_care' ELSE 'seasonal' END AS category,
         p_retailprice AS price,
         CASE WHEN l_discount >= 0.08e0 THEN 1 ELSE 0 END AS promotion,
         CASE WHEN l_quantity <= 2 THEN 1 ELSE 0 END AS stockout,
         55e0 + month(l_shipdate) AS temperature,
         cast(l_quantity AS bigint) AS units_sold,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

BRONZE = """
bronze AS (
  SELECT date, store_id, sku_id, category, price, promotion, stockout, temperature, units_sold
  FROM (SELECT *, row_number() OVER (
          PARTITION BY date, store_id, sku_id
          ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount) AS position
        FROM raw)
  WHERE position = 1)"""

SILVER = """
clipped AS (
  SELECT * REPLACE (CASE WHEN units_sold < 0 THEN 0 ELSE units_sold END AS units_sold,
                    CASE WHEN price < 0.01e0 THEN 0.01e0 ELSE price END AS price)
  FROM bronze),
silver AS (
  SELECT *, price * units_sold AS revenue,
         CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         isodow(date) - 1 AS day_of_week,
         month(date) AS month,
         weekofyear(date) AS week_of_year
  FROM clipped)"""


def _frame(n: int) -> str:
    return f"(PARTITION BY store_id, sku_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def _guard(function: str, value: str, window: str, minimum: int) -> str:
    return f"CASE WHEN count({value}) OVER {window} >= {minimum} THEN {function}({value}) OVER {window} END"


LAGS = ", ".join(f"lag(units_sold, {k}) OVER (PARTITION BY store_id, sku_id ORDER BY date) AS lag_{k}_units" for k in (1, 7, 14))
MEANS = ", ".join(
    f"{_guard('avg', 'units_sold', _frame(n), m)} AS rolling_{n}_mean_units" for n, m in ((7, 3), (14, 5), (28, 7))
)
STDS = ", ".join(
    f"{_guard('stddev_samp', 'units_sold', _frame(n), m)} AS rolling_{n}_std_units" for n, m in ((7, 3), (14, 5))
)
EXPANDING = (
    "(PARTITION BY store_id, sku_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
)
STORE_EXPANDING = "(PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
CYCLES = (
    "sin(2 * pi() * day_of_week / 7) AS day_sin, cos(2 * pi() * day_of_week / 7) AS day_cos, "
    "sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos"
)

FEATURES = f"""
series AS (
  SELECT *, {LAGS}, {MEANS}, {STDS},
         {_guard('avg', 'units_sold', EXPANDING, 3)} AS sku_avg_units, {CYCLES},
         promotion * price AS promotion_price, concat(store_id, '::', sku_id) AS entity_id
  FROM silver),
prices AS (SELECT sku_id, avg(price) AS sku_avg_price FROM silver GROUP BY sku_id),
daily AS (SELECT store_id, date, avg(units_sold) AS store_day_units FROM silver GROUP BY store_id, date),
history AS (
  SELECT *, {_guard('avg', 'store_day_units', STORE_EXPANDING, 3)} AS store_avg_units FROM daily),
wide AS (
  SELECT series.*, price - sku_avg_price AS price_vs_sku_avg,
         rolling_7_mean_units - rolling_28_mean_units AS rolling_mean_delta_7_28, store_avg_units
  FROM series LEFT JOIN prices USING (sku_id) LEFT JOIN history USING (store_id, date)),
features AS (
  SELECT * FROM wide
  WHERE units_sold IS NOT NULL AND store_id IS NOT NULL AND sku_id IS NOT NULL
    AND {' AND '.join(f'{c} IS NOT NULL' for c in FEATURE_COLUMNS)})"""

SPLIT = """
split AS (
  SELECT features.*,
         CASE WHEN date < last_date - 20 - 21 THEN 'train'
              WHEN date < last_date - 20 THEN 'validation' ELSE 'test' END AS split
  FROM features, (SELECT max(date) AS last_date FROM features))"""

LOG = """
forecasts AS (
  SELECT *, 'naive' AS model_version, rolling_7_mean_units AS predicted_units,
         cast(units_sold AS double) AS actual_units FROM split
  UNION ALL
  SELECT *, 'lag_7' AS model_version, cast(lag_7_units AS double) AS predicted_units,
         cast(units_sold AS double) AS actual_units FROM split),
naive AS (SELECT * FROM forecasts WHERE model_version = 'naive'),
ranked AS (
  SELECT model_version, abs(predicted_units - actual_units) AS error,
         row_number() OVER (PARTITION BY model_version ORDER BY abs(predicted_units - actual_units)) - 1 AS position,
         count(*) OVER (PARTITION BY model_version) AS n
  FROM forecasts WHERE split = 'validation'),
radii AS (
  SELECT model_version, any_value(n) AS calibration_rows, max(error) AS interval_radius
  FROM ranked
  WHERE position = ceil((n - 1) * least(1e0, ceil((n + 1) * 0.9e0) / n))
  GROUP BY model_version),
log AS (
  SELECT forecasts.*, greatest(predicted_units - interval_radius, 0) AS prediction_lower,
         predicted_units + interval_radius AS prediction_upper, 0.9e0 AS prediction_interval_coverage,
         interval_radius, calibration_rows
  FROM forecasts LEFT JOIN radii USING (model_version)),
test_log AS (SELECT * FROM log WHERE split = 'test')"""

METRICS = {
    "mae": "avg(abs(predicted_units - actual_units))",
    "median_absolute_error": "quantile_cont(abs(predicted_units - actual_units), 0.5)",
    "p90_absolute_error": "quantile_cont(abs(predicted_units - actual_units), 0.9)",
    "rmse": "sqrt(avg((predicted_units - actual_units) * (predicted_units - actual_units)))",
    "mape": "avg(abs(predicted_units - actual_units) / greatest(abs(actual_units), 1))",
    "wape": "CASE WHEN sum(abs(actual_units)) > 0 THEN sum(abs(predicted_units - actual_units)) / sum(abs(actual_units)) ELSE 0 END",
    "smape": "avg(abs(predicted_units - actual_units) / greatest((abs(actual_units) + abs(predicted_units)) / 2, 1))",
    "r2": "CASE WHEN var_pop(actual_units) > 0 THEN 1 - sum((predicted_units - actual_units) ** 2) / (var_pop(actual_units) * count(*)) "
    "WHEN sum((predicted_units - actual_units) ** 2) = 0 THEN 1 ELSE 0 END",
    "bias": "avg(predicted_units - actual_units)",
    "under_forecast_rate": "avg(CASE WHEN predicted_units < actual_units THEN 1e0 ELSE 0 END)",
    "over_forecast_rate": "avg(CASE WHEN predicted_units > actual_units THEN 1e0 ELSE 0 END)",
    "rmsle": "sqrt(avg((ln(1 + greatest(predicted_units, 0)) - ln(1 + greatest(actual_units, 0))) ** 2))",
}
METRIC_LIST = ", ".join(f"{e} AS {n}" for n, e in METRICS.items())
METRIC_OUT = ", ".join(num(e, n) for n, e in METRICS.items())

CONFORMAL = {
    "observed_coverage": "avg(CASE WHEN actual_units BETWEEN predicted_units - interval_radius AND predicted_units + interval_radius THEN 1e0 ELSE 0 END)",
    "interval_radius": "max(interval_radius)",
    "mean_interval_width": "2 * max(interval_radius)",
    "below_interval_rate": "avg(CASE WHEN actual_units < predicted_units - interval_radius THEN 1e0 ELSE 0 END)",
    "above_interval_rate": "avg(CASE WHEN actual_units > predicted_units + interval_radius THEN 1e0 ELSE 0 END)",
    "mean_interval_score": "avg(2 * interval_radius "
    "+ 20e0 * greatest(predicted_units - interval_radius - actual_units, 0) "
    "+ 20e0 * greatest(actual_units - predicted_units - interval_radius, 0))",
}

# Bins: sorted values per model, interpolated edges, repaired left to right, counts per half-open bin.
STEPS = ", ".join(f"{i * 0.1!r}e0" if i < 10 else "1e0" for i in range(11))
def psi_over(source: str) -> str:
    """Observed shares and PSI of the rows of a table, for models that have bins."""
    return f"""
observed AS (
  SELECT bins.model_version, bin, any_value(expected_share) AS expected_share,
         count(*) FILTER ((bin = 0 OR predicted_units >= lower_edge) AND (bin = 9 OR predicted_units < upper_edge))
           / count(*)::double AS observed_share
  FROM bins JOIN {source} AS seen ON seen.model_version = bins.model_version
  GROUP BY bins.model_version, bin),
psi_bins AS (
  SELECT model_version,
         sum((least(greatest(observed_share, 1e-6), 1) - least(greatest(expected_share, 1e-6), 1))
             * ln(least(greatest(observed_share, 1e-6), 1) / least(greatest(expected_share, 1e-6), 1))) AS psi
  FROM observed GROUP BY model_version)"""


EDGES = f"""
sorted AS (
  SELECT model_version, list(predicted_units ORDER BY predicted_units) AS v, count(*) AS n
  FROM forecasts WHERE split = 'validation' GROUP BY model_version),
raw_edges AS (
  SELECT model_version, v, n, list_transform([{STEPS}], lambda p:
           CASE WHEN (n - 1) * p - floor((n - 1) * p) >= 0.5e0
                THEN v[ceil((n - 1) * p)::bigint + 1] - (v[ceil((n - 1) * p)::bigint + 1] - v[floor((n - 1) * p)::bigint + 1]) * (1e0 - ((n - 1) * p - floor((n - 1) * p)))
                ELSE v[floor((n - 1) * p)::bigint + 1] + (v[ceil((n - 1) * p)::bigint + 1] - v[floor((n - 1) * p)::bigint + 1]) * ((n - 1) * p - floor((n - 1) * p)) END) AS raw_edge
  FROM sorted),
raised AS (
  SELECT model_version, v, n,
         list_reduce(list_transform(raw_edge, lambda x: [x]), lambda done, x:
           list_append(done, CASE WHEN x[1] <= done[-1] THEN done[-1] + 1e-6 ELSE x[1] END)) AS e
  FROM raw_edges),
edges AS (
  SELECT model_version, v, n,
         list_transform(e, lambda x, i: CASE WHEN i = 1 THEN x - 1e-6 WHEN i = 11 THEN x + 1e-6 ELSE x END) AS bin_edges
  FROM raised),
bins AS (
  SELECT model_version, i - 1 AS bin, bin_edges[i] AS lower_edge, bin_edges[i + 1] AS upper_edge, n,
         len(list_filter(v, lambda x: (i = 1 OR x >= bin_edges[i]) AND (i = 10 OR x < bin_edges[i + 1]))) / n::double AS expected_share
  FROM edges, range(1, 11) AS r(i))"""
BINS = f"{EDGES},{psi_over('test_log')}"

STATS = """
moments AS (
  SELECT model_version, avg(predicted_units) AS mean, greatest(stddev_pop(predicted_units), 1e-6) AS std
  FROM forecasts WHERE split = 'validation' GROUP BY model_version),
spread AS (
  SELECT model_version, i, mean - 3 * std + 6 * std * i / 10e0 AS lower_edge, mean - 3 * std + 6 * std * (i + 1) / 10e0 AS upper_edge
  FROM moments, range(0, 10) AS r(i)),
spread_observed AS (
  SELECT spread.model_version, i,
         count(*) FILTER ((i = 0 OR predicted_units >= lower_edge) AND (i = 9 OR predicted_units < upper_edge))
           / count(*)::double AS share
  FROM spread JOIN forecasts ON forecasts.model_version = spread.model_version AND split = 'test'
  GROUP BY spread.model_version, i),
psi_stats AS (
  SELECT model_version, sum((greatest(share, 1e-6) - 0.1e0) * ln(greatest(share, 1e-6) / 0.1e0)) AS psi
  FROM spread_observed GROUP BY model_version)"""

TRAIN_STATS = "train_stats AS (" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, avg({c}) AS reference_mean, stddev_samp({c}) AS reference_std FROM split WHERE split = 'train'"
    for i, c in enumerate(FEATURE_COLUMNS)
) + ")"


def _shift(source: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    means = " UNION ALL ".join(
        f"SELECT {keys}'{c}' AS feature, avg({c}) AS observed_mean FROM {source}{group}" for c in FEATURE_COLUMNS
    )
    return f"""
observed_means AS ({means}),
shifts AS (
  SELECT {keys}feature, observed_mean, reference_mean,
         (observed_mean - reference_mean) / greatest(abs(reference_std), 1e-6) AS standardized_shift
  FROM observed_means JOIN train_stats USING (feature))"""


SEGMENTS = """
segments AS (
  SELECT model_version, concat('store_id=', store_id, ' / category=', category) AS segment, count(*) AS rows,
         avg(actual_units) AS mean_actual, avg(predicted_units) AS mean_predicted,
         avg(abs(predicted_units - actual_units)) AS mae,
         sum(abs(predicted_units - actual_units)) / sum(abs(actual_units)) AS wape,
         avg(predicted_units - actual_units) AS bias
  FROM log GROUP BY model_version, store_id, category HAVING count(*) >= 5),
ranked_segments AS (
  SELECT *, row_number() OVER (PARTITION BY model_version ORDER BY mae DESC, rows DESC, segment) AS place FROM segments)"""

INTERVALS = """
intervals AS (
  SELECT model_version, count(*) AS rows,
         avg(CASE WHEN actual_units BETWEEN prediction_lower AND prediction_upper THEN 1e0 ELSE 0 END) AS observed_coverage,
         avg(prediction_upper - prediction_lower) AS mean_interval_width,
         avg(CASE WHEN actual_units < prediction_lower THEN 1e0 ELSE 0 END) AS below_interval_rate,
         avg(CASE WHEN actual_units > prediction_upper THEN 1e0 ELSE 0 END) AS above_interval_rate
  FROM log GROUP BY model_version)"""

SIGNALS = f"""
quality AS (
  SELECT model_version, count(*) AS rows, {METRICS['mae']} AS mae, {METRICS['wape']} AS wape, {METRICS['bias']} AS bias
  FROM log GROUP BY model_version),
reference AS (
  SELECT model_version, {METRICS['mae']} AS reference_mae FROM forecasts WHERE split = 'validation' GROUP BY model_version),
signals AS (
  SELECT quality.model_version, quality.rows, quality.mae, quality.wape, quality.bias, psi,
         (SELECT max(abs(standardized_shift)) FROM shifts WHERE shifts.model_version = quality.model_version) AS max_feature_shift,
         observed_coverage AS interval_coverage, segment AS worst_segment, ranked_segments.mae AS segment_mae,
         reference_mae, CASE WHEN reference_mae IS NOT NULL THEN 0.9e0 END AS target_coverage
  FROM quality LEFT JOIN reference USING (model_version) LEFT JOIN psi_bins USING (model_version)
  LEFT JOIN intervals USING (model_version)
  LEFT JOIN ranked_segments ON ranked_segments.model_version = quality.model_version AND place = 1)"""

ALERTS = """
rules AS (
  SELECT model_version, 0 AS ordinal, 'prediction_drift' AS type, 'high' AS severity, psi >= 0.01e0 AS fired,
         psi AS value, 0.01e0 AS threshold, NULL AS segment,
         'prediction PSI exceeded the monitoring threshold' AS message FROM signals
  UNION ALL
  SELECT model_version, 1, 'feature_drift', 'high', max_feature_shift >= 0.05e0, max_feature_shift, 0.05e0, NULL,
         'feature mean shift exceeded the monitoring threshold' FROM signals
  UNION ALL
  SELECT model_version, 2, 'interval_undercoverage', 'high', interval_coverage < target_coverage, interval_coverage,
         target_coverage, NULL, 'prediction interval coverage fell below its calibrated target' FROM signals
  UNION ALL
  SELECT model_version, 3, 'error_degradation', 'high', mae > reference_mae * 1.01e0, mae, reference_mae * 1.01e0, NULL,
         'current MAE degraded against the training reference' FROM signals
  UNION ALL
  SELECT model_version, 4, 'forecast_bias', 'medium', abs(bias) > reference_mae * 0.01e0, bias, reference_mae * 0.01e0, NULL,
         'forecast bias is large relative to the training error scale' FROM signals
  UNION ALL
  SELECT model_version, 5, 'segment_error', 'medium', segment_mae > reference_mae * 1.01e0 * 1.25e0, segment_mae,
         reference_mae * 1.01e0 * 1.25e0, worst_segment,
         'one monitored segment is materially worse than baseline' FROM signals),
alerts AS (SELECT * FROM rules WHERE fired),
fired AS (
  SELECT model_version, count(*) AS alert_count, arg_min(message, ordinal) AS first_message,
         string_agg(type, ',' ORDER BY ordinal) AS alert_types,
         CASE WHEN bool_or(severity = 'high') THEN 'high' WHEN bool_or(severity = 'medium') THEN 'medium' ELSE 'low' END AS priority
  FROM alerts GROUP BY model_version),
known_steps(place, type, step) AS (VALUES
  (0, 'prediction_drift', 'refresh the recent scoring window and compare demand distribution against training'),
  (1, 'feature_drift', 'inspect shifted input features and verify upstream data contracts'),
  (2, 'error_degradation', 'retrain the candidate model and compare it against the current champion gate'),
  (3, 'forecast_bias', 'inspect systematic over/under-forecasting before promotion'),
  (4, 'segment_error', 'review the worst store/category segments and add segment-specific diagnostics'),
  (5, 'interval_undercoverage', 'recalibrate forecast intervals on a recent labeled validation window')),
steps AS (
  SELECT model_version, row_number() OVER (PARTITION BY model_version ORDER BY place) - 1 AS position, step
  FROM (SELECT DISTINCT model_version, place, step FROM alerts JOIN known_steps USING (type)))"""

MONITOR = (EDGES, psi_over("log"), TRAIN_STATS, _shift("log", "model_version"), SEGMENTS, INTERVALS, SIGNALS, ALERTS)

VERSIONS = (
    "versions AS ("
    + " UNION ALL ".join(
        f"SELECT '{v}' AS model_version, cast({c} AS double) AS predicted_units, cast(units_sold AS double) AS actual_units "
        "FROM split WHERE split = 'validation'"
        for v, c in (
            ("v1_rolling_7", "rolling_7_mean_units"),
            ("v2_rolling_28", "rolling_28_mean_units"),
            ("v3_lag_1", "lag_1_units"),
            ("v4_series_mean", "sku_avg_units"),
        )
    )
    + f"""),
version_metrics AS (
  SELECT model_version, {METRICS['r2']} AS r2, {METRICS['mae']} AS mae FROM versions GROUP BY model_version),
candidates AS (
  SELECT *, (SELECT mae FROM version_metrics WHERE model_version = 'v1_rolling_7') AS baseline_mae,
         (SELECT mae FROM version_metrics WHERE model_version = 'v2_rolling_28') AS champion_mae
  FROM version_metrics),
gated AS (
  SELECT *, CASE WHEN r2 < -1 THEN 'validation r2 is below the minimum gate'
                 WHEN mae > baseline_mae * 1.05e0 THEN 'candidate does not improve enough over the rolling baseline'
                 WHEN mae > champion_mae * 1.02e0 THEN 'candidate regresses beyond the allowed champion MAE tolerance'
                 ELSE 'candidate passed validation quality gates' END AS reason
  FROM candidates)"""
)

FOLDS = """
days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS position, count(*) OVER () AS total
         FROM (SELECT DISTINCT date FROM history_rows)),
folds AS (
  SELECT fold, date, CASE WHEN position < total - 21 * (3 - fold) - 21 THEN 'train' ELSE 'validation' END AS part
  FROM days, range(1, 4) AS r(fold) WHERE position < total - 21 * (3 - fold))"""



def backtest(column: str) -> str:
    return f"""
history_rows AS (SELECT *, cast({column} AS double) AS predicted_units, cast(units_sold AS double) AS actual_units FROM split WHERE split <> 'test'),
{FOLDS.strip()},
fold_parts AS (
  SELECT fold, max(date) FILTER (part = 'train') AS train_end, min(date) FILTER (part = 'validation') AS validation_start,
         max(date) FILTER (part = 'validation') AS validation_end, count(*) FILTER (part = 'train') AS train_rows,
         count(*) FILTER (part = 'validation') AS validation_rows
  FROM history_rows JOIN folds USING (date) GROUP BY fold),
fold_metrics AS (
  SELECT fold, {METRIC_LIST} FROM history_rows JOIN folds USING (date) WHERE part = 'validation' GROUP BY fold)"""

LAYERS = (RAW, BRONZE, SILVER)
GOLD = (*LAYERS, FEATURES, SPLIT)
SCORED = (*GOLD, LOG)


def oracle(name: str, select: str, ctes: tuple[str, ...]) -> None:
    ORACLES[name] = f"WITH {','.join(c.strip() if not c.startswith(chr(10)) else c for c in ctes)}\n{select}"


# --- sources and layers
RAW_OUT = f"{day()}, store_id, sku_id, category, {nums('price')}, cast(promotion AS bigint) AS promotion, cast(stockout AS bigint) AS stockout, {nums('temperature')}, units_sold"
CALENDAR_OUT = "cast(is_weekend AS bigint) AS is_weekend, cast(day_of_week AS bigint) AS day_of_week, cast(month AS bigint) AS month, cast(week_of_year AS bigint) AS week_of_year"
oracle("raw_scan", f"SELECT {RAW_OUT} FROM raw", (RAW,))
oracle("bronze_dedup", f"SELECT {RAW_OUT} FROM bronze", (RAW, BRONZE))
oracle("bronze_arrivals", f"SELECT {RAW_OUT} FROM bronze", (RAW, BRONZE))
oracle("bronze_sorted", f"SELECT {RAW_OUT} FROM bronze ORDER BY 1, 2, 3", (RAW, BRONZE))
COPIES = (
    "SELECT count(*) AS rows, sum(copies) - count(*) AS removed "
    "FROM (SELECT count(*) AS copies FROM raw GROUP BY date, store_id, sku_id)"
)
oracle(
    "bronze_checks",
    f"SELECT rows, '{','.join(RAW_COLUMNS)}' AS columns, cast(removed AS bigint) AS duplicates_removed FROM ({COPIES})",
    (RAW,),
)
oracle("silver_clip", f"SELECT {KEYS}, {nums('price')}, units_sold FROM clipped", LAYERS)
oracle("silver_calendar", f"SELECT {KEYS}, {CALENDAR_OUT} FROM silver", LAYERS)
oracle("silver_table", f"SELECT {RAW_OUT}, {nums('revenue')}, {CALENDAR_OUT} FROM silver", LAYERS)
SILVER_CHECKS = (
    f"SELECT count(*) AS rows, {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')}, "
    "count(*) FILTER (units_sold < 0) AS negative_units FROM silver"
)
oracle("silver_checks", SILVER_CHECKS, LAYERS)
oracle(
    "layer_manifest",
    f"""SELECT 'bronze' AS layer, 'raw' AS source, unnest(['rows', 'columns', 'duplicates_removed']) AS "check",
       unnest([cast(rows AS varchar), '{','.join(RAW_COLUMNS)}', cast(removed AS varchar)]) AS value FROM ({COPIES})
UNION ALL
SELECT 'silver', 'bronze', unnest(['rows', 'min_date', 'max_date', 'negative_units']),
       unnest([cast(rows AS varchar), min_date, max_date, cast(negative_units AS varchar)]) FROM ({SILVER_CHECKS})""",
    LAYERS,
)

# --- features
oracle("lag_features", f"SELECT {KEYS}, {LAGS} FROM silver", LAYERS)
oracle(
    "rolling_mean",
    f"SELECT {KEYS}, {nums('rolling_7_mean_units', 'rolling_14_mean_units', 'rolling_28_mean_units')}, "
    f"{num('rolling_7_mean_units - rolling_28_mean_units', 'rolling_mean_delta_7_28')} FROM series",
    (*LAYERS, FEATURES),
)
oracle("rolling_std", f"SELECT {KEYS}, {nums('rolling_7_std_units', 'rolling_14_std_units')} FROM series", (*LAYERS, FEATURES))
oracle("cyclic_features", f"SELECT {KEYS}, {nums('day_sin', 'day_cos', 'month_sin', 'month_cos')} FROM series", (*LAYERS, FEATURES))
oracle(
    "price_vs_sku_avg",
    f"SELECT {KEYS}, {num('price')}, {num('price - avg(price) OVER (PARTITION BY sku_id)', 'price_vs_sku_avg')} FROM silver",
    LAYERS,
)
oracle(
    "price_vs_prior_avg",
    f"""SELECT {KEYS}, {num('price')}, {num('price - total / n', 'price_vs_sku_avg')} FROM silver JOIN
  (SELECT sku_id AS sku, date AS day, sum(s) OVER w AS total, sum(c) OVER w AS n
   FROM (SELECT sku_id, date, sum(price) AS s, count(price) AS c FROM silver GROUP BY sku_id, date)
   WINDOW w AS (PARTITION BY sku_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  ON sku_id = sku AND date = day""",
    LAYERS,
)
oracle(
    "features_by_batches",
    f"""SELECT {day('series.date', 'date')}, series.store_id AS store_id, series.sku_id AS sku_id, lag_1_units, lag_7_units, lag_14_units,
  {nums('rolling_7_mean_units', 'rolling_14_mean_units', 'rolling_28_mean_units', 'rolling_7_std_units', 'rolling_14_std_units')},
  {num('rolling_7_mean_units - rolling_28_mean_units', 'rolling_mean_delta_7_28')}, {num('sku_avg_units')},
  {num('history.store_avg_units', 'store_avg_units')}, {num('price - total / n', 'price_vs_sku_avg')}
FROM series LEFT JOIN history ON history.store_id = series.store_id AND history.date = series.date LEFT JOIN
  (SELECT sku_id AS sku, date AS day, sum(s) OVER w AS total, sum(c) OVER w AS n
   FROM (SELECT sku_id, date, sum(price) AS s, count(price) AS c FROM silver GROUP BY sku_id, date)
   WINDOW w AS (PARTITION BY sku_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  ON series.sku_id = sku AND series.date = day""",
    (*LAYERS, FEATURES),
)
oracle("interaction_features", f"SELECT {KEYS}, {num('promotion * price', 'promotion_price')} FROM silver", LAYERS)
oracle("expanding_sku_mean", f"SELECT {KEYS}, {num('sku_avg_units')} FROM series", (*LAYERS, FEATURES))
oracle("store_daily_mean", f"SELECT store_id, {day()}, {num('store_day_units')} FROM daily", (*LAYERS, FEATURES))
oracle("expanding_store_mean", f"SELECT store_id, {day()}, {nums('store_day_units', 'store_avg_units')} FROM history", (*LAYERS, FEATURES))
oracle(
    "store_mean_join",
    f"SELECT {KEYS}, {num('store_avg_units')} FROM silver LEFT JOIN history USING (store_id, date)",
    (*LAYERS, FEATURES),
)
oracle("entity_id", f"SELECT {KEYS}, store_id || '::' || sku_id AS entity_id FROM silver", LAYERS)
COUNTS = ("promotion", "stockout", "is_weekend", "lag_1_units", "lag_7_units", "lag_14_units")
SILVER_NAMES = (*RAW_COLUMNS, "revenue", "is_weekend", "day_of_week", "month", "week_of_year")
NUMBERS = [c for c in FEATURE_COLUMNS if c not in COUNTS and c not in SILVER_NAMES]
oracle(
    "feature_table",
    f"SELECT {RAW_OUT}, {nums('revenue')}, {CALENDAR_OUT}, lag_1_units, lag_7_units, lag_14_units, {nums(*NUMBERS)}, entity_id FROM features",
    (*LAYERS, FEATURES),
)
REDUCED_SERIES = f"""
reduced AS (
  SELECT * EXCLUDE (day_of_week),
         isodow(date) % 7 AS day_of_week,
         lag(units_sold, 1) OVER (PARTITION BY store_id, sku_id ORDER BY date) AS lag_1_units,
         lag(units_sold, 7) OVER (PARTITION BY store_id, sku_id ORDER BY date) AS lag_7_units,
         avg(units_sold) OVER {_frame(7)} AS rolling_7_mean_units,
         avg(units_sold) OVER {_frame(14)} AS rolling_14_mean_units,
         stddev_samp(units_sold) OVER {_frame(7)} AS rolling_7_std_units,
         concat_ws('::', store_id, sku_id) AS entity_id
  FROM silver),
reduced_features AS (
  SELECT *, {CYCLES} FROM reduced WHERE lag_7_units IS NOT NULL AND rolling_7_std_units IS NOT NULL)"""
oracle(
    "feature_table_reduced",
    f"SELECT {RAW_OUT}, {nums('revenue')}, {CALENDAR_OUT}, lag_1_units, lag_7_units, "
    f"{nums('rolling_7_mean_units', 'rolling_14_mean_units', 'rolling_7_std_units', 'day_sin', 'day_cos', 'month_sin', 'month_cos')}, entity_id "
    "FROM reduced_features",
    (*LAYERS, REDUCED_SERIES),
)

# --- encoding and splits
oracle(
    "one_hot_wide",
    " UNION ALL ".join(
        f"SELECT {KEYS}, '{c}_' || {c} AS feature, 1e0 AS value FROM features WHERE {c} IN (SELECT {c} FROM split WHERE split = 'train')"
        for c in CATEGORICAL_COLUMNS
    ),
    GOLD,
)
INT_FEATURES = ("promotion", "stockout", "is_weekend")
FEATURE_OUT = ", ".join(
    f"cast({c} AS bigint) AS {c}" if c in INT_FEATURES else c if c in COUNTS else num(c) for c in FEATURE_COLUMNS
)
oracle("align_columns", f"SELECT {KEYS}, {FEATURE_OUT}, 0e0 AS sku_id_never_seen FROM features", (*LAYERS, FEATURES))
oracle(
    "model_matrix",
    f"SELECT {KEYS}, cast({len(FEATURE_COLUMNS)} + stores + skus + groups AS bigint) AS width, "
    f"cast({len(FEATURE_COLUMNS)} + stores + skus + groups AS bigint) AS vector_size, "
    f"{num(' + '.join(FEATURE_COLUMNS) + ' + 3', 'checksum')} FROM features, "
    "(SELECT count(DISTINCT store_id) AS stores, count(DISTINCT sku_id) AS skus, count(DISTINCT category) AS groups FROM features)",
    (*LAYERS, FEATURES),
)
oracle("time_split", f"SELECT {KEYS}, split FROM split", GOLD)
oracle(
    "rolling_origin",
    f"SELECT {KEYS}, cast(fold AS bigint) AS fold, part AS split FROM history_rows JOIN folds USING (date)",
    (*GOLD, "history_rows AS (SELECT * FROM split)", FOLDS),
)
oracle("distinct_dates", f"SELECT DISTINCT {day()} FROM silver", LAYERS)
oracle("tagged_union", f"SELECT {KEYS}, units_sold, split FROM split", GOLD)

# --- metrics and intervals
oracle("regression_metrics", f"SELECT {METRIC_OUT} FROM naive", SCORED)
oracle("regression_metrics_by_store", f"SELECT store_id, {METRIC_OUT} FROM naive GROUP BY store_id", SCORED)
oracle(
    "pinball_loss",
    f"SELECT store_id, {num('avg(greatest(0.75e0 * (actual_units - predicted_units), -0.25e0 * (actual_units - predicted_units)))', 'pinball_loss')} "
    "FROM naive GROUP BY store_id",
    SCORED,
)
COST = "2e0 * greatest(actual_units - predicted_units, 0) + greatest(predicted_units - actual_units, 0)"
oracle(
    "inventory_cost",
    f"SELECT store_id, {num(f'avg({COST})', 'mean_inventory_cost')}, {num(f'sum({COST})', 'total_inventory_cost')}, "
    f"{num('avg(greatest(actual_units - predicted_units, 0))', 'mean_shortage_units')}, "
    f"{num('avg(greatest(predicted_units - actual_units, 0))', 'mean_excess_units')}, "
    f"{num('2e0 / 3e0', 'implied_service_quantile')} FROM naive GROUP BY store_id",
    SCORED,
)
oracle(
    "mase_by_series",
    f"""SELECT store_id, sku_id, {num('CASE WHEN steps > 0 AND scale > 2.220446049250313e-16 THEN mae / scale END', 'mase')} FROM
  (SELECT store_id, sku_id, avg(abs(predicted_units - actual_units)) AS mae FROM naive WHERE split = 'test' GROUP BY ALL)
  LEFT JOIN (SELECT store_id, sku_id, avg(step) AS scale, count(step) AS steps FROM
          (SELECT store_id, sku_id, abs(units_sold - lag(units_sold, 7) OVER (PARTITION BY store_id, sku_id ORDER BY date)) AS step
           FROM split WHERE split = 'train') GROUP BY ALL)
  USING (store_id, sku_id)""",
    SCORED,
)
ORACLES["mase_without_history"] = ORACLES["mase_by_series"].replace(
    "FROM split WHERE split = 'train')", "FROM split WHERE split = 'train' AND sku_id > 'Brand#2')"
)
RESIDUAL = "predicted_units - actual_units"
RESIDUAL_OUT = {
    "mean": f"avg({RESIDUAL})",
    "median": f"quantile_cont({RESIDUAL}, 0.5)",
    "p10": f"quantile_cont({RESIDUAL}, 0.1)",
    "p90": f"quantile_cont({RESIDUAL}, 0.9)",
    "max_abs": f"max(abs({RESIDUAL}))",
}
oracle(
    "residual_summary",
    f"SELECT model_version, {', '.join(num(e, n) for n, e in RESIDUAL_OUT.items())} FROM forecasts GROUP BY model_version",
    SCORED,
)
oracle("conformal_radius", f"SELECT calibration_rows, {num('interval_radius')} FROM radii WHERE model_version = 'naive'", SCORED)
oracle(
    "conformal_radius_by_store",
    f"""SELECT store_id, any_value(n) AS calibration_rows, {num('max(error)', 'interval_radius')} FROM (
  SELECT store_id, abs({RESIDUAL}) AS error, row_number() OVER (PARTITION BY store_id ORDER BY abs({RESIDUAL})) - 1 AS position,
         count(*) OVER (PARTITION BY store_id) AS n
  FROM naive WHERE split = 'validation')
WHERE position = ceil((n - 1) * least(1e0, ceil((n + 1) * 0.9e0) / n)) GROUP BY store_id""",
    SCORED,
)
ORACLES["conformal_radius_textbook"] = ORACLES["conformal_radius_by_store"].replace(
    "position = ceil((n - 1) * least(1e0, ceil((n + 1) * 0.9e0) / n))", "position = least(n - 1, ceil((n + 1) * 0.9e0) - 1)"
)
CONFORMAL_OUT = ", ".join(num(e, n) for n, e in CONFORMAL.items())
oracle(
    "conformal_summary",
    f"SELECT model_version, 0.9e0 AS target_coverage, {CONFORMAL_OUT}, max(calibration_rows) AS calibration_rows, count(*) AS test_rows "
    "FROM test_log GROUP BY model_version",
    SCORED,
)
BOUNDS_OUT = f"{nums('prediction_lower', 'prediction_upper')}, prediction_interval_coverage"
oracle("prediction_intervals", f"SELECT {KEYS}, model_version, {num('predicted_units')}, {BOUNDS_OUT} FROM log", SCORED)
oracle(
    "test_predictions",
    f"SELECT {KEYS}, units_sold, {num('predicted_units', 'prediction')}, {num(f'abs({RESIDUAL})', 'absolute_error')}, "
    f"{nums('prediction_lower', 'prediction_upper')} FROM test_log WHERE model_version = 'naive'",
    SCORED,
)

# --- models and scoring
oracle("naive_forecast", f"SELECT {KEYS}, {num('rolling_7_mean_units', 'predicted_units')} FROM features", (*LAYERS, FEATURES))
oracle(
    "model_vs_baseline",
    f"SELECT model_version, split, {nums(*METRICS)}, {num('mae / baseline_mae', 'mae_vs_baseline')} FROM ("
    f"SELECT model_version, split, {METRIC_LIST} FROM forecasts WHERE split <> 'train' GROUP BY model_version, split) "
    f"JOIN (SELECT split, {METRICS['mae']} AS baseline_mae FROM naive GROUP BY split) USING (split)",
    SCORED,
)
oracle(
    "backtest_naive",
    f"SELECT cast(fold AS bigint) AS fold, {day('train_end')}, {day('validation_start')}, {day('validation_end')}, train_rows, validation_rows, "
    f"{nums(*METRICS)} FROM fold_parts JOIN fold_metrics USING (fold)",
    (*GOLD, backtest("rolling_7_mean_units")),
)
oracle(
    "batch_score_naive",
    f"SELECT {KEYS}, category, {FEATURE_OUT}, model_version, '2026-01-01T00:00:00+00:00' AS prediction_timestamp, "
    f"{nums('predicted_units', 'actual_units')}, {BOUNDS_OUT}, {num(f'abs({RESIDUAL})', 'absolute_error')} "
    "FROM log WHERE model_version = 'naive'",
    SCORED,
)
NAIVE_RADIUS = "(SELECT interval_radius FROM radii WHERE model_version = 'naive')"
oracle(
    "score_records",
    f"SELECT {KEYS}, 'naive' AS model_version, {num('predicted_units')}, {num(f"greatest(predicted_units - {NAIVE_RADIUS}, 0)", "prediction_lower")}, "
    f"{num(f"predicted_units + {NAIVE_RADIUS}", "prediction_upper")}, 0.9e0 AS prediction_interval_coverage FROM naive",
    SCORED,
)
oracle(
    "score_stream",
    f"SELECT {KEYS}, 'naive' AS model_version, {num('predicted_units')}, {num(f"greatest(predicted_units - {NAIVE_RADIUS}, 0)", "prediction_lower")}, "
    f"{num(f"predicted_units + {NAIVE_RADIUS}", "prediction_upper")}, 0.9e0 AS prediction_interval_coverage FROM naive",
    SCORED,
)
SUMMARY_OUT = (
    "count(*) AS rows, count(DISTINCT store_id) AS unique_stores, count(DISTINCT sku_id) AS unique_skus, true AS has_actuals, "
    f"{num('min(predicted_units)', 'min_predicted_units')}, {num('quantile_cont(predicted_units, 0.5)', 'p50_predicted_units')}, "
    f"{num('quantile_cont(predicted_units, 0.9)', 'p90_predicted_units')}, {num('max(predicted_units)', 'max_predicted_units')}"
)
oracle("prediction_summary", f"SELECT model_version, {SUMMARY_OUT} FROM log GROUP BY model_version", SCORED)
oracle("batch_metrics", f"SELECT model_version, {SUMMARY_OUT}, {METRIC_OUT} FROM log GROUP BY model_version", SCORED)

# --- profiles and drift
SPREAD_OUT = ", ".join(num(f"quantile_cont(predicted_units, {p})", n) for n, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)))
oracle(
    "prediction_profile",
    f"SELECT model_version, count(*) AS rows, {num('avg(predicted_units)', 'mean')}, {num('stddev_pop(predicted_units)', 'std')}, "
    f"{SPREAD_OUT}, {METRIC_OUT} FROM log GROUP BY model_version",
    SCORED,
)
oracle(
    "training_profile",
    f"SELECT count(*) AS row_count, {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')}, "
    f"{num('avg(units_sold)', 'target_mean')}, {num('stddev_samp(units_sold)', 'target_std')} FROM split WHERE split = 'train'",
    GOLD,
)
CATEGORY_STATS = " UNION ALL ".join(
    f"SELECT '{c}_' || v AS feature, avg(CASE WHEN {c} = v THEN 1e0 ELSE 0 END) AS reference_mean, "
    f"stddev_samp(CASE WHEN {c} = v THEN 1e0 ELSE 0 END) AS reference_std "
    f"FROM (SELECT * FROM split WHERE split = 'train'), (SELECT DISTINCT {c} AS v FROM split) GROUP BY v"
    for c in CATEGORICAL_COLUMNS
)
oracle(
    "feature_profile",
    f"SELECT feature, {num('reference_mean', 'mean')}, {num('reference_std', 'std')} "
    f"FROM (SELECT feature, reference_mean, reference_std FROM train_stats UNION ALL {CATEGORY_STATS})",
    (*GOLD, TRAIN_STATS),
)
oracle(
    "reference_bins",
    f"SELECT model_version, cast(bin AS bigint) AS bin, {nums('lower_edge', 'upper_edge', 'expected_share')} FROM bins",
    (*SCORED, BINS),
)
TWENTIETHS = ", ".join(f"{i / 20!r}e0" for i in range(21))
oracle(
    "edge_repair",
    f"""SELECT sku_id, cast(i - 1 AS bigint) AS position, {num('e[i] + CASE i WHEN 1 THEN -1e-6 WHEN 21 THEN 1e-6 ELSE 0 END', 'edge')} FROM (
  SELECT sku_id, list_reduce(list_transform(q, lambda x: [x]), lambda done, x:
           list_append(done, CASE WHEN x[1] <= done[-1] THEN done[-1] + 1e-6 ELSE x[1] END)) AS e
  FROM (SELECT sku_id, quantile_cont(cast(units_sold AS double), [{TWENTIETHS}]) AS q FROM silver GROUP BY sku_id)),
range(1, 22) AS r(i)""",
    LAYERS,
)
oracle("psi_from_bins", f"SELECT model_version, {num('psi')} FROM psi_bins", (*SCORED, BINS))
oracle("psi_from_stats", f"SELECT model_version, {num('psi')} FROM psi_stats", (*SCORED, STATS))
oracle(
    "psi_dispatch",
    f"SELECT model_version, {num('psi')} FROM (SELECT * FROM psi_bins WHERE model_version = 'naive' "
    "UNION ALL SELECT * FROM psi_stats WHERE model_version <> 'naive')",
    (*SCORED, BINS, STATS),
)
oracle(
    "feature_mean_shift",
    f"SELECT feature, {nums('observed_mean', 'reference_mean', 'standardized_shift')}, "
    f"{num('abs(standardized_shift)', 'absolute_standardized_shift')} FROM shifts",
    (*GOLD, TRAIN_STATS, "test_rows AS (SELECT * FROM split WHERE split = 'test')", _shift("test_rows")),
)
EXPECTED = sorted([*FEATURE_COLUMNS, "category"])
oracle(
    "feature_schema_report",
    f"""SELECT cast({len(EXPECTED) + 1} AS bigint) AS expected_feature_count, cast({len(EXPECTED)} AS bigint) AS present_feature_count,
       {num(f'{len(EXPECTED)}e0 / {len(EXPECTED) + 1}', 'coverage')}, 'humidity' AS missing_features,
       concat_ws('; ', {', '.join(f"CASE WHEN numbers_{c} = 0 THEN '{c}' END" for c in EXPECTED)}) AS non_numeric_features,
       concat_ws('; ', {', '.join(f"CASE WHEN numbers_{c} BETWEEN 1 AND rows - 1 THEN '{c}' END" for c in EXPECTED)}) AS non_finite_features,
       false AS valid
FROM (SELECT count(*) AS rows, {', '.join(f"count(try_cast({c} AS double)) AS numbers_{c}" for c in EXPECTED)} FROM features)""",
    (*LAYERS, FEATURES),
)
oracle(
    "log_round_trip",
    f"SELECT {KEYS}, model_version, {nums('predicted_units', 'actual_units')} FROM naive",
    SCORED,
)
oracle("csv_round_trip", f"SELECT {RAW_OUT} FROM raw", (RAW,))

# --- quality and alerts
oracle(
    "interval_quality",
    f"SELECT model_version, rows, {nums('observed_coverage', 'mean_interval_width', 'below_interval_rate', 'above_interval_rate')} FROM intervals",
    (*SCORED, INTERVALS),
)
oracle(
    "segment_quality",
    f"SELECT model_version, segment, rows, {nums('mean_actual', 'mean_predicted', 'mae', 'wape', 'bias')} FROM ranked_segments WHERE place <= 10",
    (*SCORED, SEGMENTS),
)
oracle(
    "rolling_quality",
    f"""SELECT model_version, cast(block AS bigint) AS "window", cast(block * 50 AS bigint) AS start_row, count(*) AS rows,
       {num(METRICS['mae'], 'mae')}, {num(METRICS['wape'], 'wape')}, {num(METRICS['bias'], 'bias')},
       {day('min(date)', 'start_date')}, {day('max(date)', 'end_date')}
FROM (SELECT *, (row_number() OVER (PARTITION BY model_version ORDER BY date, store_id, sku_id) - 1) // 50 AS block FROM forecasts)
GROUP BY model_version, block""",
    SCORED,
)
ORACLES["monitor_blocks"] = ORACLES["rolling_quality"]
oracle(
    "row_positions",
    """SELECT line, row_number() OVER (ORDER BY line) - 1 AS row_index
FROM (SELECT DISTINCT (l_orderkey * 1000 + l_linenumber) * 1000000 + l_partkey AS line FROM raw)""",
    (RAW,),
)
oracle("monitor_metrics", f"SELECT model_version, {METRIC_OUT} FROM log GROUP BY model_version", SCORED)
BLANK = "cast(NULL AS double)"
oracle(
    "monitor_unlabelled",
    f"SELECT model_version, rows, {BLANK} AS mae, {BLANK} AS wape, {BLANK} AS bias, {nums('psi', 'max_feature_shift')}, "
    f"{BLANK} AS interval_coverage, {num('target_coverage')}, {num('reference_mae')}, {BLANK} AS segment_mae, "
    "cast(NULL AS varchar) AS worst_segment FROM signals",
    (*SCORED, *MONITOR),
)
oracle(
    "monitor_stored_baseline",
    f"SELECT model_version, rows, {nums('mae', 'wape', 'bias', 'psi', 'max_feature_shift', 'interval_coverage')}, "
    f"{nums('target_coverage', 'reference_mae', 'segment_mae')}, worst_segment FROM signals",
    (*SCORED, *MONITOR),
)
oracle(
    "drift_over_time",
    f"SELECT model_version, {day()}, cast(any_value(total) AS bigint) AS rows, "
    + num("sum((least(greatest(n / total, 1e-6), 1) - least(greatest(expected_share, 1e-6), 1)) "
    "* ln(least(greatest(n / total, 1e-6), 1) / least(greatest(expected_share, 1e-6), 1)))", "psi")
    + " FROM windowed GROUP BY model_version, date",
    (
        *SCORED,
        EDGES,
        """
bin_days AS (
  SELECT bins.model_version, date, bin, any_value(expected_share) AS expected_share,
         count(*) FILTER ((bin = 0 OR predicted_units >= lower_edge) AND (bin = 9 OR predicted_units < upper_edge)) AS n
  FROM bins JOIN log ON log.model_version = bins.model_version GROUP BY bins.model_version, date, bin),
summed AS (
  SELECT d.model_version, d.date, d.bin, any_value(d.expected_share) AS expected_share, sum(e.n)::double AS n
  FROM bin_days d JOIN bin_days e ON e.model_version = d.model_version AND e.bin = d.bin AND e.date BETWEEN d.date - 27 AND d.date
  GROUP BY d.model_version, d.date, d.bin),
windowed AS (SELECT *, sum(n) OVER (PARTITION BY model_version, date) AS total FROM summed)""",
    ),
)
WIDER = LOG.replace(
    "cast(units_sold AS double) AS actual_units FROM split),",
    "cast(units_sold AS double) AS actual_units FROM split\n  UNION ALL\n"
    "  SELECT *, 'lag_14' AS model_version, cast(lag_14_units AS double) AS predicted_units,\n"
    "         cast(units_sold AS double) AS actual_units FROM split),",
).replace("GROUP BY model_version),\nlog AS", "AND model_version <> 'lag_14' GROUP BY model_version),\nlog AS")
NEW_MODEL = (
    *GOLD,
    WIDER,
    EDGES.replace("WHERE split = 'validation'", "WHERE split = 'validation' AND model_version <> 'lag_14'"),
    psi_over("log"),
    SEGMENTS,
    INTERVALS.replace("FROM log", "FROM log WHERE prediction_upper IS NOT NULL"),
    "shifts AS (SELECT '' AS model_version, 0e0 AS standardized_shift WHERE false)",
    SIGNALS.replace("WHERE split = 'validation'", "WHERE split = 'validation' AND model_version <> 'lag_14'"),
)
oracle(
    "monitor_new_model",
    f"SELECT model_version, rows, {nums('mae', 'wape', 'bias', 'psi')}, {BLANK} AS max_feature_shift, "
    f"{nums('interval_coverage', 'target_coverage', 'reference_mae', 'segment_mae')}, worst_segment FROM signals",
    NEW_MODEL,
)
oracle(
    "intervals_new_model",
    "SELECT model_version, count(*) AS rows, count(prediction_upper) AS bounded_rows FROM log GROUP BY model_version",
    (*GOLD, WIDER),
)
oracle(
    "monitoring_alerts",
    f"SELECT model_version, cast(ordinal AS bigint) AS ordinal, type, severity, {nums('value', 'threshold')}, segment, message FROM alerts",
    (*SCORED, *MONITOR),
)
oracle(
    "monitor_summary",
    f"SELECT signals.model_version, rows, {nums('mae', 'wape', 'bias', 'psi', 'max_feature_shift', 'interval_coverage')}, worst_segment, "
    f"{nums('segment_mae', 'reference_mae')}, target_coverage, coalesce(alert_count, 0) AS alert_count, coalesce(alert_types, '') AS alert_types, "
    "coalesce(alert_count, 0) > 0 AS retrain_recommended, coalesce(first_message, 'no retraining trigger crossed') AS reason "
    "FROM signals LEFT JOIN fired USING (model_version)",
    (*SCORED, *MONITOR),
)
oracle("retraining_priority", "SELECT model_version, priority FROM fired", (*SCORED, *MONITOR))
oracle("retraining_steps", "SELECT model_version, position, step FROM steps", (*SCORED, *MONITOR))
oracle(
    "retraining_plan",
    """SELECT signals.model_version, '2026-01-01T00:00:00+00:00' AS created_at, alert_count IS NOT NULL AS triggered,
       CASE WHEN alert_count IS NOT NULL THEN 'ready_to_retrain' ELSE 'no_action' END AS status,
       coalesce(first_message, 'no retraining trigger crossed') AS reason, coalesce(priority, 'low') AS priority,
       coalesce(replace(alert_types, ',', '; '), '') AS alert_types,
       coalesce((SELECT string_agg(step, '; ' ORDER BY position) FROM steps WHERE steps.model_version = signals.model_version), '') AS next_steps,
       CASE WHEN alert_count IS NOT NULL THEN 'spark-submit retrain.py' ELSE '' END AS retrain_command,
       'monitor_summary' AS source_report
FROM signals LEFT JOIN fired USING (model_version)""",
    (*SCORED, *MONITOR),
)

# --- governance
oracle(
    "promotion_gate",
    f"SELECT model_version, {nums('r2', 'mae', 'baseline_mae', 'champion_mae')}, reason, "
    "reason = 'candidate passed validation quality gates' AS promoted FROM gated",
    (*GOLD, VERSIONS),
)
oracle(
    "promotion_scorecard",
    f"SELECT model_version, {num('mae', 'candidate_mae')}, {num('r2', 'candidate_r2')}, {num('baseline_mae')}, "
    f"{num('baseline_mae - mae', 'mae_improvement_vs_baseline')}, {num('mae / baseline_mae', 'mae_ratio_vs_baseline')}, "
    f"-1e0 AS minimum_validation_r2, {num('champion_mae')}, {num('mae - champion_mae', 'mae_delta_vs_champion')} FROM gated",
    (*GOLD, VERSIONS),
)
STAGED = (
    "SELECT model_version AS version, CASE WHEN reason = 'candidate passed validation quality gates' THEN 'champion' ELSE 'candidate' END AS stage, "
    "mae, r2, reason AS promotion_reason, '2026-01-0' || substr(model_version, 2, 1) || ' 06:00:00' AS registered_at FROM gated"
)
oracle(
    "model_versions",
    f"SELECT version, stage, {nums('mae', 'r2')}, promotion_reason, registered_at FROM ({STAGED})",
    (*GOLD, VERSIONS),
)
oracle(
    "current_champion",
    f"SELECT version, {nums('mae', 'r2')}, registered_at FROM ({STAGED}) WHERE stage = 'champion' ORDER BY registered_at DESC, version DESC LIMIT 1",
    (*GOLD, VERSIONS),
)
oracle(
    "champion_scores",
    f"""SELECT {KEYS}, version AS model_version, {num('greatest(forecast, 0)', 'predicted_units')}, {num('cast(units_sold AS double)', 'actual_units')},
       {num('greatest(greatest(forecast, 0) - interval_radius, 0)', 'prediction_lower')}, {num('greatest(forecast, 0) + interval_radius', 'prediction_upper')}
FROM (SELECT *, CASE version WHEN 'v1_rolling_7' THEN rolling_7_mean_units WHEN 'v2_rolling_28' THEN rolling_28_mean_units
                             WHEN 'v3_lag_1' THEN lag_1_units ELSE sku_avg_units END AS forecast
      FROM features, champion)""",
    (
        *GOLD,
        VERSIONS,
        f"champion_version AS (SELECT version FROM ({STAGED}) WHERE stage = 'champion' ORDER BY registered_at DESC, version DESC LIMIT 1)",
        "champion_errors AS (SELECT abs(predicted_units - actual_units) AS error, row_number() OVER (ORDER BY abs(predicted_units - actual_units)) - 1 AS position, "
        "count(*) OVER () AS n FROM versions WHERE model_version = (SELECT version FROM champion_version))",
        "champion AS (SELECT version, error AS interval_radius FROM champion_version, champion_errors "
        "WHERE position = ceil((n - 1) * least(1e0, ceil((n + 1) * 0.9e0) / n)))",
    ),
)
oracle("gbt_forecast", f"SELECT {KEYS}, units_sold, true AS is_number FROM split WHERE split = 'test'", GOLD)
oracle(
    "backtest_gbt",
    f"SELECT cast(fold AS bigint) AS fold, {day('train_end')}, {day('validation_start')}, {day('validation_end')}, train_rows, validation_rows, "
    "true AS all_numbers, true AS errors_ordered, true AS quantiles_ordered, true AS rates_are_shares FROM fold_parts",
    (*GOLD, backtest("rolling_7_mean_units")),
)
SEASON = "20 + CASE WHEN isodow(l_shipdate) >= 6 THEN 30 ELSE 0 END + 2 * month(l_shipdate) + 5 * cast(n_regionkey AS bigint)"
SEASONAL = RAW.replace("cast(l_quantity AS bigint) AS units_sold", f"{SEASON} AS units_sold")
oracle(
    "tree_candidate",
    f"SELECT model_version, split, {num('baseline_mae')}, model_version = 'trees' AS beats_baseline FROM ("
    "SELECT split, avg(abs(rolling_7_mean_units - units_sold)) AS baseline_mae FROM split WHERE split <> 'train' GROUP BY split), "
    "(SELECT unnest(['naive', 'trees']) AS model_version)",
    (SEASONAL, BRONZE, SILVER, FEATURES, SPLIT),
)
oracle(
    "batch_score",
    f"SELECT {KEYS}, category, 'trees' AS model_version, '2026-01-01T00:00:00+00:00' AS prediction_timestamp, "
    f"{num('cast(units_sold AS double)', 'actual_units')}, 0.9e0 AS prediction_interval_coverage, true AS all_numbers, "
    "true AS not_negative, true AS inside_interval, true AS error_agrees FROM features",
    (*LAYERS, FEATURES),
)
oracle(
    "run_params_long",
    """SELECT 'run-1' AS run_id, unnest(['model_type', 'feature_count', 'training.validation_days', 'training.test_days']) AS name,
       unnest(['naive', width, '21', '21']) AS value
FROM (SELECT cast(22 + count(DISTINCT store_id) + count(DISTINCT sku_id) + count(DISTINCT category) AS varchar) AS width
      FROM split WHERE split = 'train')
UNION ALL
SELECT 'run-1', concat(split, '_rows'), cast(count(*) AS varchar) FROM split GROUP BY split""",
    GOLD,
)


def _long(group: str, names, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'run-1' AS run_id, '{group}_{n}' AS name, {num(f'cast({n} AS double)', 'value')} FROM {source}" for n in names
    )


oracle(
    "run_metrics_long",
    " UNION ALL ".join(
        [
            _long("validation", (*METRICS, "mae_vs_baseline"), "held_validation"),
            _long("test", METRICS, "held_test"),
            _long("baseline_validation", METRICS, "base_validation"),
            _long("baseline_test", METRICS, "base_test"),
            _long("residuals", RESIDUAL_OUT, "held_residuals"),
            _long("prediction_interval", ("target_coverage", *CONFORMAL, "calibration_rows", "test_rows"), "held_interval"),
            _long("rolling_origin", ("mean_mae", "mean_wape", "mae_std"), "held_folds"),
        ]
    ),
    (
        *SCORED,
        backtest("lag_7_units"),
        f"base_validation AS (SELECT {METRIC_LIST} FROM naive WHERE split = 'validation')",
        f"base_test AS (SELECT {METRIC_LIST} FROM naive WHERE split = 'test')",
        f"held_validation AS (SELECT *, mae / (SELECT mae FROM base_validation) AS mae_vs_baseline FROM "
        f"(SELECT {METRIC_LIST} FROM forecasts WHERE model_version = 'lag_7' AND split = 'validation'))",
        f"held_test AS (SELECT {METRIC_LIST} FROM forecasts WHERE model_version = 'lag_7' AND split = 'test')",
        f"held_residuals AS (SELECT {', '.join(f'{e} AS {n}' for n, e in RESIDUAL_OUT.items())} FROM test_log WHERE model_version = 'lag_7')",
        f"held_interval AS (SELECT 0.9e0 AS target_coverage, {', '.join(f'{e} AS {n}' for n, e in CONFORMAL.items())}, "
        "max(calibration_rows) AS calibration_rows, count(*) AS test_rows FROM test_log WHERE model_version = 'lag_7')",
        "held_folds AS (SELECT avg(mae) AS mean_mae, avg(wape) AS mean_wape, stddev_pop(mae) AS mae_std FROM fold_metrics)",
    ),
)

# --- stored tables
ORACLES["committed_log"] = ORACLES["log_round_trip"]
ORACLES["stored_versions"] = ORACLES["model_versions"]
ORACLES["stored_champion_scores"] = ORACLES["champion_scores"]
oracle("dated_slice", f"SELECT {KEYS}, units_sold, lag_1_units FROM split WHERE split = 'test'", GOLD)
oracle(
    "dated_manifest",
    f"SELECT strftime(date, '%Y-%m') AS date_bucket, {day('min(date)', 'min_date')}, {day('max(date)', 'max_date')}, count(*) AS rows "
    "FROM silver GROUP BY strftime(date, '%Y-%m')",
    LAYERS,
)
oracle(
    "quality_stream",
    f"""SELECT model_version, {day('start', 'window_start')}, {day('start + 28', 'window_end')}, count(*) AS rows,
  {num('avg(abs(predicted_units - actual_units))', 'mae')},
  {num('CASE WHEN sum(abs(actual_units)) > 0 THEN sum(abs(predicted_units - actual_units)) / sum(abs(actual_units)) ELSE 0 END', 'wape')},
  {num('avg(predicted_units - actual_units)', 'bias')},
  {num('avg(CASE WHEN actual_units BETWEEN prediction_lower AND prediction_upper THEN 1e0 ELSE 0e0 END)', 'observed_coverage')}
FROM (SELECT *, (date - cast((date - DATE '1970-01-01') % 28 AS int))::date AS start FROM log) GROUP BY model_version, start""",
    SCORED,
)
