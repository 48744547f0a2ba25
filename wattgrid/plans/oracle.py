"""Independent SQL (DuckDB dialect) for every driver query with an exact
SQL form.  Written from the semantics, not from the Spark plans: windows use
explicit frames, ratios are DOUBLE literals, doubles are rounded to 6 places.
"""

from __future__ import annotations

import math
import re

from ..sources.tables import EVENT_CHANNELS

CH = EVENT_CHANNELS
TF_INT = ["hour", "day_of_week", "day_of_month", "month", "is_weekend"]
TF_DBL = ["hour_sin", "hour_cos", "day_sin", "day_cos"]


def R(expr: str) -> str:
    """Round to 6 places in two steps (9 places first) so that summation-order
    noise cannot flip a half-way case."""
    return f"round(({expr})::DECIMAL(38,9), 6)::DOUBLE"


def r6(expr: str, alias: str) -> str:
    return f"{R(expr)} AS {alias}"


def cols(fmt: str, names=CH, sep: str = ", ") -> str:
    return sep.join(fmt.format(c=c) for c in names)


# --- shared CTE chains -------------------------------------------------------

READINGS = f"""
readings AS (
  SELECT user_id // 10 AS home_id, event_type AS channel, ts, value AS watts, event_id AS seq
  FROM events
  WHERE event_type IN ({cols("'{c}'")}) AND value IS NOT NULL AND NOT isnan(value)
),
wide AS (
  SELECT home_id, ts, {cols("arg_min(watts, seq) FILTER (WHERE channel = '{c}') AS {c}")}
  FROM readings GROUP BY home_id, ts
)"""

def binned_ctes(interval: str = "1 hour") -> str:
    """Readings -> per-home bins of ``interval`` -> full grid named ``hourly``."""
    return READINGS + f""",
binned AS (
  SELECT home_id, time_bucket(INTERVAL {interval}, ts) AS ts, {cols("avg({c}) AS {c}")}
  FROM wide GROUP BY 1, 2
),
bounds AS (SELECT home_id, min(ts) AS lo, max(ts) AS hi FROM binned GROUP BY home_id),
grid AS (SELECT home_id, unnest(generate_series(lo, hi, INTERVAL {interval})) AS ts FROM bounds),
hourly AS (
  SELECT grid.home_id, grid.ts, {cols("binned.{c}")}
  FROM grid LEFT JOIN binned ON grid.home_id = binned.home_id AND grid.ts = binned.ts
)"""


HOURLY = binned_ctes("1 hour")

W_BACK = "OVER (PARTITION BY home_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
W_FWD = "OVER (PARTITION BY home_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def filled_cte(method: str = "ffill", src: str = "hourly", name: str = "filled") -> str:
    if method == "ffill":
        body = cols(f"coalesce(last_value({{c}} IGNORE NULLS) {W_BACK}, first_value({{c}} IGNORE NULLS) {W_FWD}) AS {{c}}")
        return f"{name} AS (SELECT home_id, ts, {body} FROM {src})"
    if method == "bfill":
        body = cols(f"coalesce(first_value({{c}} IGNORE NULLS) {W_FWD}, last_value({{c}} IGNORE NULLS) {W_BACK}) AS {{c}}")
        return f"{name} AS (SELECT home_id, ts, {body} FROM {src})"
    if method == "drop":
        return f"{name} AS (SELECT * FROM {src} WHERE {cols('{c} IS NOT NULL', sep=' AND ')})"
    if method == "interpolate":
        ep = "epoch_us(ts)"
        pre = cols(f"""last_value(CASE WHEN {{c}} IS NOT NULL THEN {ep} END IGNORE NULLS) {W_BACK} AS {{c}}_pt,
          last_value({{c}} IGNORE NULLS) {W_BACK} AS {{c}}_pv,
          first_value(CASE WHEN {{c}} IS NOT NULL THEN {ep} END IGNORE NULLS) {W_FWD} AS {{c}}_nt,
          first_value({{c}} IGNORE NULLS) {W_FWD} AS {{c}}_nv""")
        fin = cols(f"""CASE WHEN {{c}} IS NOT NULL THEN {{c}}
          WHEN {{c}}_pv IS NULL THEN NULL
          WHEN {{c}}_nv IS NULL THEN {{c}}_pv
          ELSE {{c}}_pv + ({{c}}_nv - {{c}}_pv) * (({ep} - {{c}}_pt)::DOUBLE / 1e6) / (({{c}}_nt - {{c}}_pt)::DOUBLE / 1e6) END AS {{c}}""")
        return (f"{name}_s AS (SELECT home_id, ts, {cols('{c}')}, {pre} FROM {src}),\n"
                f"{name} AS (SELECT home_id, ts, {fin} FROM {name}_s)")
    raise ValueError(method)


def calendar_sel(ts: str = "ts") -> str:
    tp = repr(2 * math.pi)
    return (f"hour({ts})::BIGINT AS hour, (isodow({ts}) - 1)::BIGINT AS day_of_week, "
            f"day({ts})::BIGINT AS day_of_month, month({ts})::BIGINT AS month, "
            f"(CASE WHEN isodow({ts}) - 1 >= 5 THEN 1 ELSE 0 END)::BIGINT AS is_weekend, "
            f"sin({tp} * hour({ts}) / 24) AS hour_sin, cos({tp} * hour({ts}) / 24) AS hour_cos, "
            f"sin({tp} * (isodow({ts}) - 1) / 7) AS day_sin, cos({tp} * (isodow({ts}) - 1) / 7) AS day_cos")


def outlier_cte(src: str, name: str, threshold: float = 3.0) -> str:
    stats = cols("avg({c}) OVER (PARTITION BY home_id) AS {c}_m, stddev_samp({c}) OVER (PARTITION BY home_id) AS {c}_s")
    keep = cols(f"coalesce(abs(({{c}} - {{c}}_m) / nullif({{c}}_s, 0)) < {threshold}, false)", sep=" AND ")
    return (f"{name}_z AS (SELECT *, {stats} FROM {src}),\n"
            f"{name} AS (SELECT * EXCLUDE ({cols('{c}_m, {c}_s')}) FROM {name}_z WHERE {keep})")


def minmax_cte(src: str, name: str) -> str:
    sc = cols("({c} - min({c}) OVER (PARTITION BY home_id)) / CASE WHEN max({c}) OVER (PARTITION BY home_id) "
              "- min({c}) OVER (PARTITION BY home_id) = 0 THEN 1.0 ELSE max({c}) OVER (PARTITION BY home_id) "
              "- min({c}) OVER (PARTITION BY home_id) END AS {c}")
    return f"{name} AS (SELECT * REPLACE ({sc}) FROM {src})"


def processed_ctes(interval: str = "1 hour") -> str:
    return (binned_ctes(interval) + ",\n" + filled_cte("ffill") + ",\n" + outlier_cte("filled", "clean") +
            f",\ncal AS (SELECT clean.*, {calendar_sel()} FROM clean),\n" + minmax_cte("cal", "processed"))


def rounded_select(src: str, ints=("home_id",), dbl=CH, other=("ts",)) -> str:
    parts = [*ints, *other, *[r6(c, c) for c in dbl]]
    return f"SELECT {', '.join(parts)} FROM {src}"


# --- queries -------------------------------------------------------------------

SQL = {}

SQL["channel_filter"] = """
WITH raw AS (
  SELECT 'TimeSeriesVariable' || CAST(user_id % 12 AS VARCHAR) AS variable_id, ts, value AS watts, event_id AS seq
  FROM events
),
dim AS (
  SELECT 'TimeSeriesVariable' || CAST(k AS VARCHAR) AS variable_id, 1::BIGINT AS home_id,
         CASE WHEN k = 1 THEN 'Aggregate' ELSE 'Appliance' || CAST(k - 1 AS VARCHAR) END AS channel
  FROM range(1, 11) t(k)
)
SELECT seq, raw.variable_id, home_id, channel, ts, round((watts)::DECIMAL(38,9), 6)::DOUBLE AS watts
FROM raw JOIN dim ON raw.variable_id = dim.variable_id
WHERE regexp_matches(raw.variable_id, 'TimeSeriesVariable[1-9]$|TimeSeriesVariable10$')
"""

SQL["channel_select"] = """
WITH k AS (SELECT user_id % 12 AS k, ts, value, event_id FROM events WHERE value IS NOT NULL AND NOT isnan(value))
SELECT 1::BIGINT AS home_id, ts,
       round((arg_min(value, event_id) FILTER (WHERE k = 1))::DECIMAL(38,9), 6)::DOUBLE AS Aggregate,
       round((arg_min(value, event_id) FILTER (WHERE k = 2))::DECIMAL(38,9), 6)::DOUBLE AS Appliance1,
       round((arg_min(value, event_id) FILTER (WHERE k = 10))::DECIMAL(38,9), 6)::DOUBLE AS Appliance9
FROM k WHERE k BETWEEN 1 AND 10 GROUP BY ts
"""

SQL["pivot_first"] = f"""
WITH r AS (
  SELECT user_id // 10 AS home_id, event_type AS channel, time_bucket(INTERVAL 1 hour, ts) AS ts,
         value AS watts, event_id AS seq
  FROM events WHERE event_type IN ({cols("'{c}'")}) AND value IS NOT NULL
)
SELECT home_id, ts, {cols("round((arg_min(watts, seq) FILTER (WHERE channel = '{c}'))::DECIMAL(38,9), 6)::DOUBLE AS {c}")}
FROM r GROUP BY home_id, ts
"""

SQL["resample_mean"] = f"WITH {HOURLY}\n" + rounded_select("binned")
SQL["resample_gapfill"] = f"WITH {HOURLY}\n" + rounded_select("hourly")
SQL["missing_count"] = f"""WITH {HOURLY}
SELECT home_id, sum({cols("({c} IS NULL)::BIGINT", sep=" + ")})::BIGINT AS n_missing, count(*)::BIGINT AS n_rows
FROM hourly GROUP BY home_id
"""
for _m in ("ffill", "bfill", "interpolate", "drop"):
    SQL[f"fill_{_m}"] = f"WITH {HOURLY},\n{filled_cte(_m)}\n" + rounded_select("filled")

SQL["calendar_features"] = (f"WITH {HOURLY},\n{filled_cte('ffill')},\n"
                            f"c AS (SELECT filled.*, {calendar_sel()} FROM filled)\n"
                            f"SELECT home_id, ts, {cols('round(({c})::DECIMAL(38,9), 6)::DOUBLE AS {c}')}, {', '.join(TF_INT)}, "
                            f"{', '.join(r6(c, c) for c in TF_DBL)} FROM c")

SQL["outlier_filter"] = f"WITH {HOURLY},\n{filled_cte('ffill')},\n{outlier_cte('filled', 'clean')}\n" + \
    rounded_select("clean")

SQL["outlier_counts"] = f"""WITH {HOURLY},\n{filled_cte('ffill')},\n{outlier_cte('filled', 'clean')},
b AS (SELECT home_id, count(*) AS n_before FROM filled GROUP BY home_id),
a AS (SELECT home_id, count(*) AS n_after FROM clean GROUP BY home_id)
SELECT b.home_id, n_before::BIGINT AS n_before, coalesce(n_after, 0)::BIGINT AS n_after,
       (n_before - coalesce(n_after, 0))::BIGINT AS n_removed,
       {R('(n_before - coalesce(n_after, 0)) / n_before::DOUBLE * 100')} AS pct_removed
FROM b LEFT JOIN a USING (home_id)"""

SQL["minmax_fit"] = f"""WITH {HOURLY},\n{filled_cte('ffill')}
SELECT home_id, "column", round((data_min)::DECIMAL(38,9), 6)::DOUBLE AS data_min, round((data_max)::DECIMAL(38,9), 6)::DOUBLE AS data_max FROM (
  {' UNION ALL '.join(f"SELECT home_id, '{c}' AS \"column\", min({c})::DOUBLE AS data_min, max({c})::DOUBLE AS data_max FROM filled GROUP BY home_id" for c in CH)}
)
"""

SQL["minmax_transform"] = f"WITH {HOURLY},\n{filled_cte('ffill')},\n{minmax_cte('filled', 'scaled')}\n" + \
    rounded_select("scaled")

SQL["preprocessed_series"] = (f"WITH {processed_ctes()}\n"
                              f"SELECT home_id, ts, {cols('round(({c})::DECIMAL(38,9), 6)::DOUBLE AS {c}')}, {', '.join(TF_INT)}, "
                              f"{', '.join(r6(c, c) for c in TF_DBL)} FROM processed")

# --- features, split, sequences ------------------------------------------------

LAGS, WINDOWS, HORIZON, SEQ_LEN = [1, 2, 3, 4], [4, 8, 12], 4, 24
TARGET = CH[0]
W_ORD = "OVER (PARTITION BY home_id ORDER BY ts)"


def lag_sel() -> list[tuple[str, str]]:
    return [(f"lag({c}, {k}) {W_ORD}", f"{c}_lag_{k}") for c in CH for k in LAGS]


def rolling_sel() -> list[tuple[str, str]]:
    out = []
    for c in CH:
        for w in WINDOWS:
            frame = f"OVER (PARTITION BY home_id ORDER BY ts ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            out += [(f"avg({c}) {frame}", f"{c}_rolling_mean_{w}"), (f"sum({c}) {frame}", f"{c}_rolling_sum_{w}"),
                    (f"stddev_samp({c}) {frame}", f"{c}_rolling_std_{w}")]
    return out


def target_sel() -> tuple[str, str]:
    return (f"lead({TARGET}, {HORIZON}) {W_ORD}", "target")


def _with_filled() -> str:
    return f"WITH {HOURLY},\n{filled_cte('ffill')}"


def _derived_query(sel: list[tuple[str, str]]) -> str:
    inner = ", ".join(f"{e} AS {a}" for e, a in sel)
    outer = ", ".join(r6(a, a) for _, a in sel)
    return (f"{_with_filled()},\nd AS (SELECT *, {inner} FROM filled)\n"
            f"SELECT home_id, ts, {cols('round(({c})::DECIMAL(38,9), 6)::DOUBLE AS {c}')}, {outer} FROM d")


SQL["lag_features"] = _derived_query(lag_sel())
SQL["rolling_features"] = _derived_query(rolling_sel())
SQL["future_target"] = _derived_query([target_sel()])

FEATURE_SEL = lag_sel() + rolling_sel() + [target_sel()]
FEATURE_NAMES = [a for _, a in FEATURE_SEL]


def features_ctes(interval: str = "1 hour") -> str:
    inner = ", ".join(f"{e} AS {a}" for e, a in FEATURE_SEL)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in [*CH, *TF_INT, *TF_DBL, *FEATURE_NAMES])
    return (f"{processed_ctes(interval)},\nfx AS (SELECT *, {inner} FROM processed),\n"
            f"features AS (SELECT * FROM fx WHERE {not_null})")


def split_ctes() -> str:
    te = f"floor(n * {0.70!r})"
    ve = f"floor(n * {0.70 + 0.15!r})"
    return (f"{features_ctes()},\nsp AS (SELECT *, (row_number() OVER (PARTITION BY home_id ORDER BY ts) - 1) AS pos, "
            f"count(*) OVER (PARTITION BY home_id)::DOUBLE AS n FROM features),\n"
            f"split AS (SELECT * EXCLUDE (pos, n), CASE WHEN pos < {te} THEN 'train' WHEN pos < {ve} THEN 'val' "
            f"ELSE 'test' END AS split FROM sp)")


def feature_matrix_sql(interval: str = "1 hour") -> str:
    return (f"WITH {features_ctes(interval)}\n"
            f"SELECT home_id, ts, {cols('round(({c})::DECIMAL(38,9), 6)::DOUBLE AS {c}')}, {', '.join(TF_INT)}, "
            f"{', '.join(r6(c, c) for c in TF_DBL)}, {', '.join(r6(a, a) for a in FEATURE_NAMES)} "
            f"FROM features")


SQL["feature_matrix"] = feature_matrix_sql("1 hour")
SQL["feature_matrix_15min"] = feature_matrix_sql("15 minutes")
SQL["resample_gapfill_15min"] = f"WITH {binned_ctes('15 minutes')}\n" + rounded_select("hourly")

SQL["chrono_split"] = f"WITH {split_ctes()}\nSELECT home_id, ts, round((target)::DECIMAL(38,9), 6)::DOUBLE AS target, split FROM split"

SQL["split_ranges"] = (f"WITH {split_ctes()}\nSELECT home_id, split, count(*)::BIGINT AS n_rows, "
                       f"min(ts) AS first_ts, max(ts) AS last_ts FROM split GROUP BY home_id, split")

_SEQ_FRAME = f"OVER (PARTITION BY home_id, split ORDER BY ts ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING)"
SQL["sequences"] = f"""WITH {split_ctes()},
sq AS (
  SELECT home_id, split, ts,
         count(*) {_SEQ_FRAME} AS n_steps,
         sum({cols('{c}', sep=' + ')}) {_SEQ_FRAME} AS x_sum,
         first_value({CH[0]}) {_SEQ_FRAME} AS x_first,
         last_value({CH[-1]}) {_SEQ_FRAME} AS x_last,
         target AS y
  FROM split
)
SELECT home_id, split, ts, n_steps::BIGINT AS n_steps, round((x_sum)::DECIMAL(38,9), 6)::DOUBLE AS x_sum, round((x_first)::DECIMAL(38,9), 6)::DOUBLE AS x_first,
       round((x_last)::DECIMAL(38,9), 6)::DOUBLE AS x_last, round((y)::DECIMAL(38,9), 6)::DOUBLE AS y
FROM sq WHERE n_steps = {SEQ_LEN}
"""

# --- as-of, metrics, profile --------------------------------------------------------

SQL["asof_nearest"] = """
WITH l AS (SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'click'),
r AS (SELECT ts AS rts, value AS rvalue, event_id AS weather_seq FROM events WHERE event_type = 'view'),
prev AS (
  SELECT l.event_id, r.rts, r.rvalue, r.weather_seq,
         row_number() OVER (PARTITION BY l.event_id ORDER BY r.rts DESC, r.weather_seq DESC) AS rn
  FROM l JOIN r ON r.rts <= l.ts AND r.rts >= l.ts - INTERVAL 1 hour
),
nxt AS (
  SELECT l.event_id, r.rts, r.rvalue, r.weather_seq,
         row_number() OVER (PARTITION BY l.event_id ORDER BY r.rts ASC, r.weather_seq ASC) AS rn
  FROM l JOIN r ON r.rts > l.ts AND r.rts <= l.ts + INTERVAL 1 hour
),
m AS (
  SELECT l.*, p.rts AS p_ts, p.rvalue AS p_v, p.weather_seq AS p_s, n.rts AS n_ts, n.rvalue AS n_v,
         n.weather_seq AS n_s,
         (p.rts IS NOT NULL AND (n.rts IS NULL OR (l.ts - p.rts) <= (n.rts - l.ts))) AS use_prev
  FROM l LEFT JOIN prev p ON p.event_id = l.event_id AND p.rn = 1
         LEFT JOIN nxt n ON n.event_id = l.event_id AND n.rn = 1
)
SELECT event_id, user_id, ts, round((value)::DECIMAL(38,9), 6)::DOUBLE AS value_x,
       round((CASE WHEN use_prev THEN p_v ELSE n_v END)::DECIMAL(38,9), 6)::DOUBLE AS value_y,
       CASE WHEN use_prev THEN p_s ELSE n_s END AS weather_seq
FROM m
"""

_PRED = """preds AS (
  SELECT l_returnflag AS split, l_extendedprice * (1 - l_discount) AS y_true, l_extendedprice * 0.95 AS y_pred
  FROM lineitem
)"""

SQL["regression_metrics"] = f"""WITH {_PRED}
SELECT split, round((sqrt(avg((y_true - y_pred) * (y_true - y_pred))))::DECIMAL(38,9), 6)::DOUBLE AS rmse,
       round((avg(abs(y_true - y_pred)))::DECIMAL(38,9), 6)::DOUBLE AS mae,
       round((coalesce(avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100, 0.0))::DECIMAL(38,9), 6)::DOUBLE AS mape
FROM preds GROUP BY split
"""

SQL["prediction_bounds"] = f"""WITH {_PRED}
SELECT split, round((least(min(y_true), min(y_pred)))::DECIMAL(38,9), 6)::DOUBLE AS min_val,
       round((greatest(max(y_true), max(y_pred)))::DECIMAL(38,9), 6)::DOUBLE AS max_val
FROM preds GROUP BY split
"""

SQL["profile"] = f"""{_with_filled()},
long AS (UNPIVOT filled ON {cols('{c}')} INTO NAME "column" VALUE v)
SELECT home_id, "column", count(v)::BIGINT AS count, round((avg(v))::DECIMAL(38,9), 6)::DOUBLE AS mean, round((stddev_samp(v))::DECIMAL(38,9), 6)::DOUBLE AS std,
       round((min(v))::DECIMAL(38,9), 6)::DOUBLE AS min, round((quantile_cont(v, 0.25))::DECIMAL(38,9), 6)::DOUBLE AS q25, round((quantile_cont(v, 0.5))::DECIMAL(38,9), 6)::DOUBLE AS q50,
       round((quantile_cont(v, 0.75))::DECIMAL(38,9), 6)::DOUBLE AS q75, round((max(v))::DECIMAL(38,9), 6)::DOUBLE AS max
FROM long GROUP BY home_id, "column"
"""

# --- schedules: brute force over every hour choice ----------------------------------
# Homes have at most three appliances needing 1-2 hours within windows of at
# most five hours, so every combination can be listed.  The canonical optimum:
# minimum integer cost, then minimum sum of 2^(ordinal*24 + hour).

from ..constants import TARIFFS  # noqa: E402


def _tariff_values() -> str:
    rows = ", ".join(f"('{n}', {h}, {p!r}::DOUBLE)" for n in ("default", "flat", "steep")
                     for h, p in enumerate(TARIFFS[n]))
    return f"tariffs AS (SELECT * FROM (VALUES {rows}) t(tariff_id, hour, price))"


APPS = """apps AS (
  SELECT (p_partkey // 3)::BIGINT AS home_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS appliance,
         (p_partkey % 3)::INTEGER AS slot,
         1.0::DOUBLE + (p_size % 3)::DOUBLE * 0.5::DOUBLE AS runtime_hours,
         ((p_size * 7) % 24)::INTEGER AS earliest_start,
         ((p_size * 7) % 24 + 1 + p_size % 5)::INTEGER AS latest_finish,
         500.0::DOUBLE + (p_partkey % 8)::DOUBLE * 250.0::DOUBLE AS power_rating
  FROM part
),
chk AS (
  SELECT *, CASE WHEN earliest_start < 0 OR earliest_start >= 24 THEN 'start hour not within the day'
                 WHEN latest_finish <= 0 OR latest_finish > 24 THEN 'finish hour not within the day'
                 WHEN runtime_hours <= 0 THEN 'runtime not positive'
                 WHEN earliest_start + runtime_hours > latest_finish THEN 'runtime longer than the window'
                 WHEN power_rating < 0 OR NOT isfinite(power_rating) THEN 'power not finite or negative'
                 WHEN count(*) OVER (PARTITION BY home_id, appliance) > 1 THEN 'name used twice in the home' END AS violation
  FROM apps
)"""


def sched_ctes(plans_sql: str | None = None, key: str = "home_id", apps: str = APPS) -> str:
    """CTE chain ending in ``status`` (one row per home) and ``sched`` (the
    24-hour grid of optimal homes with baseline_on / is_on)."""
    plans = plans_sql or """plans AS (
  SELECT home_id, CASE home_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'flat' ELSE 'steep' END AS tariff_id,
         (1 + home_id % 2)::INTEGER AS cap
  FROM (SELECT DISTINCT home_id FROM apps)
)"""
    k = key
    return f"""{apps},
{plans},
{_tariff_values()},
homes AS (
  SELECT p.*, count(c.violation) = 0 AS valid_home, sum(ceil(c.runtime_hours)) AS total_need
  FROM plans p JOIN chk c ON c.home_id = p.home_id GROUP BY ALL
),
grid AS (
  SELECT h.{k}, c.home_id AS _h, c.appliance, c.slot, h.cap, ceil(c.runtime_hours)::INTEGER AS need,
         c.power_rating, c.power_rating / 1000.0::DOUBLE AS kw, c.runtime_hours, c.earliest_start, c.latest_finish,
         t.hour, t.price,
         (t.hour >= c.earliest_start AND t.hour < c.latest_finish) AS in_window,
         (t.hour >= c.earliest_start AND t.hour < c.earliest_start + ceil(c.runtime_hours))::INTEGER AS baseline_on,
         round(c.power_rating * t.price * 1000000.0::DOUBLE)::BIGINT AS cost_units
  FROM chk c JOIN homes h ON c.home_id = h.home_id AND h.valid_home
       JOIN tariffs t ON t.tariff_id = h.tariff_id
),
ranked AS (
  SELECT *, (in_window AND row_number() OVER (PARTITION BY {k}, appliance ORDER BY in_window DESC, price, hour)
             <= need)::INTEGER AS ranked_on
  FROM grid
),
ranked_peak AS (
  SELECT {k}, max(n) AS ranked_max FROM (SELECT {k}, hour, sum(ranked_on) AS n FROM ranked GROUP BY ALL) GROUP BY ALL
),
ords AS (
  SELECT {k}, appliance, (row_number() OVER (PARTITION BY {k} ORDER BY appliance) - 1) AS ord
  FROM (SELECT DISTINCT {k}, appliance FROM grid)
),
cells AS (
  SELECT g.*, o.ord FROM grid g JOIN ords o USING ({k}, appliance) WHERE in_window
),
cand AS (
  SELECT a.{k}, a.appliance, a.ord, a.hour AS h1, b.hour AS h2,
         a.cost_units + coalesce(b.cost_units, 0) AS cu,
         (1::HUGEINT << (a.ord * 24 + a.hour)) + coalesce(1::HUGEINT << (b.ord * 24 + b.hour), 0::HUGEINT) AS bits,
         (1::BIGINT << a.hour) | coalesce(1::BIGINT << b.hour, 0::BIGINT) AS mask
  FROM cells a LEFT JOIN cells b
    ON a.need = 2 AND b.{k} = a.{k} AND b.appliance = a.appliance AND b.hour > a.hour
  WHERE (a.need = 1 AND b.hour IS NULL) OR (a.need = 2 AND b.hour IS NOT NULL)
),
combos AS (
  SELECT c0.{k}, h.cap,
         c0.appliance AS a0, c0.h1 AS a0h1, c0.h2 AS a0h2, c1.appliance AS a1, c1.h1 AS a1h1, c1.h2 AS a1h2,
         c2.appliance AS a2, c2.h1 AS a2h1, c2.h2 AS a2h2,
         c0.cu + coalesce(c1.cu, 0) + coalesce(c2.cu, 0) AS cu,
         c0.bits + coalesce(c1.bits, 0::HUGEINT) + coalesce(c2.bits, 0::HUGEINT) AS bits,
         c0.mask AS m0, coalesce(c1.mask, 0::BIGINT) AS m1, coalesce(c2.mask, 0::BIGINT) AS m2
  FROM cand c0 JOIN homes h ON h.{k} = c0.{k}
       LEFT JOIN cand c1 ON c1.{k} = c0.{k} AND c1.ord = 1
       LEFT JOIN cand c2 ON c2.{k} = c0.{k} AND c2.ord = 2
  WHERE c0.ord = 0
),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY cu, bits) AS rn FROM combos
    WHERE CASE WHEN cap >= 3 THEN true
               WHEN cap = 2 THEN (m0 & m1 & m2) = 0
               ELSE (m0 & m1) = 0 AND (m0 & m2) = 0 AND (m1 & m2) = 0 END
  ) WHERE rn = 1
),
chosen AS (
  SELECT {k}, appliance, hour FROM (
    SELECT {k}, a0 AS appliance, a0h1 AS hour FROM best UNION ALL SELECT {k}, a0, a0h2 FROM best
    UNION ALL SELECT {k}, a1, a1h1 FROM best UNION ALL SELECT {k}, a1, a1h2 FROM best
    UNION ALL SELECT {k}, a2, a2h1 FROM best UNION ALL SELECT {k}, a2, a2h2 FROM best
  ) WHERE appliance IS NOT NULL AND hour IS NOT NULL
),
sched AS (
  SELECT g.*, (c.hour IS NOT NULL)::INTEGER AS is_on
  FROM grid g JOIN (SELECT {k} FROM best) b USING ({k})
       LEFT JOIN chosen c ON c.{k} = g.{k} AND c.appliance = g.appliance AND c.hour = g.hour
),
orig AS (SELECT {k}, sum(baseline_on * kw * price) AS original_cost FROM grid GROUP BY ALL),
opt AS (
  SELECT {k}, sum(c) AS optimized_cost, max(n)::BIGINT AS max_on
  FROM (SELECT {k}, hour, sum(is_on * kw * price) AS c, sum(is_on) AS n FROM sched GROUP BY ALL) GROUP BY ALL
),
status AS (
  SELECT h.{k}, h.cap,
         CASE WHEN NOT h.valid_home THEN 'invalid' WHEN b.{k} IS NOT NULL THEN 'optimal' ELSE 'infeasible' END
           AS status,
         CASE WHEN b.{k} IS NOT NULL THEN CASE WHEN rp.ranked_max <= h.cap THEN 'ranked' ELSE 'flow' END END
           AS path,
         o.original_cost, p.optimized_cost, p.max_on
  FROM homes h LEFT JOIN (SELECT {k} FROM best) b ON b.{k} = h.{k}
       LEFT JOIN ranked_peak rp ON rp.{k} = h.{k}
       LEFT JOIN orig o ON o.{k} = h.{k}
       LEFT JOIN opt p ON p.{k} = h.{k}
)"""


SQL["constraint_violations"] = f"""WITH {APPS}
SELECT home_id, appliance, slot, runtime_hours, earliest_start, latest_finish, power_rating, violation FROM chk
"""

SQL["tariff_check"] = """
WITH t AS (SELECT event_type AS tariff_id, hour(ts)::INTEGER AS hour, avg(value) / 1000.0 AS price
           FROM events GROUP BY 1, 2)
SELECT tariff_id, count(*)::BIGINT AS n_rows, count(DISTINCT hour)::BIGINT AS n_hours, min(hour) AS min_hour,
       max(hour) AS max_hour,
       count(*) FILTER (WHERE isfinite(price))::BIGINT AS n_priced,
       count(*) = 24 AND count(DISTINCT hour) = 24 AND count(*) FILTER (WHERE isfinite(price)) = 24
         AND min(hour) = 0 AND max(hour) = 23 AS valid
FROM t GROUP BY tariff_id
"""

SQL["baseline_schedule"] = f"WITH {sched_ctes()}\nSELECT home_id, appliance, hour, baseline_on AS is_on FROM grid"

SQL["baseline_cost"] = (f"WITH {sched_ctes()}\nSELECT home_id, {R('original_cost')} AS original_cost FROM status "
                        f"WHERE status <> 'invalid'")

SQL["schedule_uncapped"] = f"WITH {sched_ctes()}\nSELECT home_id, appliance, hour FROM ranked WHERE ranked_on = 1"

SQL["schedule_capped_cost"] = f"""WITH {sched_ctes()}
SELECT home_id, status, path, cap, max_on, {R('original_cost')} AS original_cost,
       {R('optimized_cost')} AS optimized_cost
FROM status"""

SQL["cap_check"] = f"""WITH {sched_ctes()}
SELECT home_id, cap, max(n)::BIGINT AS max_on, sum((n > cap)::BIGINT)::BIGINT AS n_over
FROM (SELECT s.home_id, s.cap, s.hour, sum(s.is_on) AS n FROM sched s GROUP BY ALL)
GROUP BY home_id, cap"""

SQL["schedule_matrix"] = (f"WITH {sched_ctes()}\nSELECT home_id, appliance, "
                          + ", ".join(f"max(is_on) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
                          + " FROM sched GROUP BY home_id, appliance")

SQL["schedule_wide"] = (f"WITH {sched_ctes()}\nSELECT home_id, hour, {R('price')} AS price, "
                        + ", ".join(f"max(is_on) FILTER (WHERE slot = {s}) AS slot_{s}" for s in range(3))
                        + " FROM sched GROUP BY home_id, hour, price")


def _clock(x: str) -> str:
    return f"coalesce(lpad(CAST({x} AS VARCHAR), 2, '0') || ':00', 'N/A')"


SQL["schedule_summary"] = f"""WITH {sched_ctes()},
a AS (
  SELECT home_id, appliance, first(power_rating) AS power_w, first(runtime_hours) AS runtime_h,
         min(hour) FILTER (WHERE baseline_on = 1) AS os, max(hour) FILTER (WHERE baseline_on = 1) + 1 AS oe,
         min(hour) FILTER (WHERE is_on = 1) AS ns, max(hour) FILTER (WHERE is_on = 1) + 1 AS ne,
         sum(baseline_on * kw * price) AS oc, sum(is_on * kw * price) AS nc
  FROM sched GROUP BY home_id, appliance
)
SELECT home_id, appliance, {R('power_w')} AS power_w, {R('runtime_h')} AS runtime_h,
       {_clock('os')} AS original_start, {_clock('oe')} AS original_end,
       {_clock('ns')} AS optimized_start, {_clock('ne')} AS optimized_end,
       printf('%.4f', oc) AS original_cost, printf('%.4f', nc) AS optimized_cost, printf('%.4f', oc - nc) AS savings
FROM a"""

SQL["savings_and_peak"] = f"""WITH {sched_ctes()},
hr AS (
  SELECT home_id, hour, sum(baseline_on) AS n_o, sum(is_on) AS n_n, sum(baseline_on * kw * price) AS c_o,
         sum(is_on * kw * price) AS c_n
  FROM sched GROUP BY home_id, hour
),
agg AS (
  SELECT home_id, sum(c_o) AS oc, sum(c_n) AS nc,
         coalesce(max(n_o)::DOUBLE / avg(n_o) FILTER (WHERE n_o > 0), 0.0) AS opa,
         coalesce(max(n_n)::DOUBLE / avg(n_n) FILTER (WHERE n_n > 0), 0.0) AS npa
  FROM hr GROUP BY home_id
)
SELECT home_id, {R('oc')} AS original_cost, {R('nc')} AS optimized_cost, {R('oc - nc')} AS absolute_savings,
       {R('CASE WHEN oc > 0 THEN (oc - nc) / oc * 100 ELSE 0.0 END')} AS percent_savings,
       {R('opa')} AS original_peak_to_avg, {R('npa')} AS optimized_peak_to_avg
FROM agg"""

SQL["hourly_power_cost"] = f"""WITH {sched_ctes()}
SELECT home_id, hour, {R('sum(baseline_on * kw)')} AS original_kw, {R('sum(is_on * kw)')} AS optimized_kw,
       {R('sum(baseline_on * kw * price)')} AS original_cost, {R('sum(is_on * kw * price)')} AS optimized_cost
FROM sched GROUP BY home_id, hour"""

SQL["results_summary"] = f"""WITH {sched_ctes()},
{_PRED},
m AS (
  SELECT sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
         coalesce(avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100, 0.0) AS mape
  FROM preds
),
s AS (
  SELECT sum(original_cost) AS oc, sum(optimized_cost) AS nc FROM status WHERE status = 'optimal'
)
SELECT * FROM (
  SELECT 0 AS position, 'Prediction RMSE' AS Metric, printf('%.4f', rmse) AS Value FROM m
  UNION ALL SELECT 1, 'Prediction MAE', printf('%.4f', mae) FROM m
  UNION ALL SELECT 2, 'Prediction MAPE (%)', printf('%.2f', mape) FROM m
  UNION ALL SELECT 3, 'Original Cost (£)', printf('%.4f', oc) FROM s
  UNION ALL SELECT 4, 'Optimized Cost (£)', printf('%.4f', nc) FROM s
  UNION ALL SELECT 5, 'Absolute Savings (£)', printf('%.4f', oc - nc) FROM s
  UNION ALL SELECT 6, 'Percent Savings (%)', printf('%.2f', CASE WHEN oc > 0 THEN (oc - nc) / oc * 100 ELSE 0 END)
  FROM s
)"""

from .scenarios import SCENARIOS  # noqa: E402


def _scenario_plans() -> str:
    vals = ", ".join(f"('{s}', '{t}', {(m if a else 1)})" for s, t, a, m in SCENARIOS)
    return f"""plans AS (
  SELECT s.scenario_id || '|' || CAST(d.home_id AS VARCHAR) AS sk, s.scenario_id, d.home_id, s.tariff_id,
         s.cap::INTEGER AS cap
  FROM (SELECT DISTINCT home_id FROM apps) d, (VALUES {vals}) s(scenario_id, tariff_id, cap)
)"""


SQL["scenario_costs"] = f"""WITH {sched_ctes(_scenario_plans(), key='sk')}
SELECT p.scenario_id, count(*)::BIGINT AS n_homes, sum((st.status = 'optimal')::BIGINT)::BIGINT AS n_optimal,
       sum((st.status = 'infeasible')::BIGINT)::BIGINT AS n_infeasible,
       sum((st.path = 'flow')::BIGINT)::BIGINT AS n_flow,
       {R("sum(st.original_cost) FILTER (WHERE st.status = 'optimal')")} AS total_original,
       {R('sum(st.optimized_cost)')} AS total_optimized
FROM status st JOIN plans p USING (sk)
GROUP BY p.scenario_id
UNION ALL
SELECT 'custom_appliance', count(*)::BIGINT, count(*)::BIGINT, 0::BIGINT, 0::BIGINT,
       {R('count(*) * any_value(c.original)')}, {R('count(*) * any_value(c.optimized)')}
FROM (SELECT DISTINCT home_id FROM apps) h CROSS JOIN (
  SELECT sum(price) FILTER (WHERE hour < 6) * 1.5::DOUBLE AS original, sum(price) FILTER (WHERE rk <= 6) * 1.5::DOUBLE AS optimized
  FROM (SELECT *, row_number() OVER (ORDER BY price, hour) AS rk FROM tariffs WHERE tariff_id = 'default')) c"""


# --- profile pieces, error columns, per-appliance and per-hour reports ----------------

SQL["date_range"] = (f"{_with_filled()}\nSELECT home_id, count(*)::BIGINT AS n_rows, min(ts) AS first_ts, "
                     f"max(ts) AS last_ts FROM filled GROUP BY home_id")

SQL["head_rows"] = f"{_with_filled()}\n" + rounded_select("filled") + " ORDER BY ts, home_id LIMIT 10"

SQL["zscore_stats"] = (f"{_with_filled()}\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT home_id, '{c}' AS \"column\", {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std "
    f"FROM filled GROUP BY home_id" for c in CH) + ")")

SQL["error_columns"] = """
SELECT l_orderkey, l_linenumber, l_returnflag AS split,
       round((l_extendedprice * (1 - l_discount))::DECIMAL(38,9), 6)::DOUBLE AS y_true,
       round((l_extendedprice * 0.95)::DECIMAL(38,9), 6)::DOUBLE AS y_pred,
       round((l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95)::DECIMAL(38,9), 6)::DOUBLE AS residual,
       round(abs(l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95)::DECIMAL(38,9), 6)::DOUBLE AS abs_error,
       round((CASE WHEN l_extendedprice * (1 - l_discount) <> 0
              THEN abs((l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95) / (l_extendedprice * (1 - l_discount))) * 100
              END)::DECIMAL(38,9), 6)::DOUBLE AS pct_error
FROM lineitem
"""

SQL["appliance_costs"] = f"""WITH {sched_ctes()}
SELECT home_id, appliance, {R('first(power_rating)')} AS power_w, {R('first(runtime_hours)')} AS runtime_h,
       min(hour) FILTER (WHERE baseline_on = 1) AS original_start,
       max(hour) FILTER (WHERE baseline_on = 1) + 1 AS original_end,
       min(hour) FILTER (WHERE is_on = 1) AS optimized_start, max(hour) FILTER (WHERE is_on = 1) + 1 AS optimized_end,
       {R('sum(baseline_on * kw * price)')} AS original_cost, {R('sum(is_on * kw * price)')} AS optimized_cost
FROM sched GROUP BY home_id, appliance"""

SQL["appliances_per_hour"] = f"""WITH {sched_ctes()}
SELECT home_id, hour, sum(is_on)::BIGINT AS n_on FROM sched GROUP BY home_id, hour"""

SQL["asof_nearest_broadcast"] = SQL["asof_nearest"]


def _nearest(left: str, right: str, hours: int, on: str = "") -> str:
    """CTEs ``prev`` and ``nxt`` (nearest right row before and after) of tables
    with columns lid, ts (left) and rts, rid (right), and ``m``: the choice."""
    side = (f"SELECT l.lid, r.*, row_number() OVER (PARTITION BY l.lid ORDER BY r.rts {{o}}, r.rid {{o}}) AS rn "
            f"FROM {left} l JOIN {right} r ON {{c}}{on}")
    before = side.format(o="DESC", c=f"r.rts <= l.ts AND r.rts >= l.ts - INTERVAL {hours} hour")
    after = side.format(o="ASC", c=f"r.rts > l.ts AND r.rts <= l.ts + INTERVAL {hours} hour")
    return f"""prev AS ({before}),
nxt AS ({after}),
m AS (
  SELECT l.lid, coalesce(CASE WHEN p.rts IS NOT NULL AND (n.rts IS NULL OR l.ts - p.rts <= n.rts - l.ts) THEN p.rid END,
                         n.rid) AS rid
  FROM {left} l LEFT JOIN prev p ON p.lid = l.lid AND p.rn = 1 LEFT JOIN nxt n ON n.lid = l.lid AND n.rn = 1
)"""


SQL["asof_nearest_keyed"] = f"""
WITH ev AS (SELECT CASE WHEN event_id % 11 <> 0 THEN user_id // 10 END AS home_id, ts, event_type, event_id,
                   CASE WHEN NOT isnan(value) THEN value END AS watts FROM events),
l AS (SELECT *, event_id AS lid FROM ev WHERE event_type = 'click'),
r AS (SELECT home_id AS h, ts AS rts, event_id AS rid, CASE WHEN event_id % 7 <> 0 THEN watts END AS w,
             CASE WHEN event_id % 5 <> 0 THEN event_id END AS feed_seq FROM ev WHERE event_type = 'view'),
{_nearest('l', 'r', 12, ' AND l.home_id = r.h')}
SELECT l.home_id, l.ts, l.event_id AS seq, {R('l.watts')} AS watts_x, {R('r.w')} AS watts_y, r.feed_seq, r.rid AS right_seq
FROM l JOIN m USING (lid) LEFT JOIN r ON r.rid = m.rid
"""

_WEATHER = [*CH, "temperature"]


def _weather_sql() -> str:
    fill = cols(f"coalesce(last_value({{c}} IGNORE NULLS) {W_BACK}, first_value({{c}} IGNORE NULLS) {W_FWD}) AS {{c}}", _WEATHER)
    return f"""WITH {READINGS},
l AS (SELECT *, row_number() OVER (ORDER BY home_id, ts) AS lid FROM wide),
r AS (SELECT ts AS rts, event_id AS rid, CASE WHEN NOT isnan(value) THEN value END AS temperature
      FROM events WHERE event_type = 'view'),
{_nearest('l', 'r', 1)},
joined AS (SELECT l.*, r.temperature FROM l JOIN m USING (lid) LEFT JOIN r ON r.rid = m.rid),
binned AS (SELECT home_id, time_bucket(INTERVAL 1 hour, ts) AS ts, {cols("avg({c}) AS {c}", _WEATHER)} FROM joined GROUP BY ALL),
bounds AS (SELECT home_id, min(ts) AS lo, max(ts) AS hi FROM binned GROUP BY home_id),
grid AS (SELECT home_id, unnest(generate_series(lo, hi, INTERVAL 1 hour)) AS ts FROM bounds),
hourly AS (SELECT grid.home_id, grid.ts, {cols("binned.{c}", _WEATHER)}
           FROM grid LEFT JOIN binned ON grid.home_id = binned.home_id AND grid.ts = binned.ts),
filled AS (SELECT home_id, ts, {fill} FROM hourly),
c AS (SELECT filled.*, {calendar_sel()} FROM filled)
SELECT home_id, ts, {', '.join(r6(c, c) for c in _WEATHER)}, {', '.join(TF_INT)}, {', '.join(r6(c, c) for c in TF_DBL)} FROM c"""


SQL["weather_features"] = _weather_sql()

SQL["combined_csv"] = f"""
WITH k AS (SELECT user_id % 12 AS k, ts, value, event_id FROM events WHERE value IS NOT NULL AND NOT isnan(value))
SELECT 1 + k // 6 AS home_id, ts, {', '.join(r6(f"arg_min(value, event_id) FILTER (WHERE k % 6 = {j})", f'Channel{j}') for j in range(6))}
FROM k GROUP BY ALL
"""

SQL["wide_csv"] = f"""WITH {READINGS}, three AS (
  SELECT home_id % 3 + 1 AS home_id, ts, {cols("arg_min(watts, seq) FILTER (WHERE channel = '{c}') AS {c}")}
  FROM readings GROUP BY ALL
)
""" + rounded_select("three")

# --- bad rows, certificates, weather file, column choice ------------------------

SQL["csv_rejects"] = """
SELECT CASE WHEN event_id % 50 = 0 THEN 'time not readable' WHEN event_id % 70 = 3 THEN 'value not readable' ELSE 'read' END AS reason,
       count(*)::BIGINT AS n_lines
FROM events GROUP BY 1"""

_POWER = "500.0::DOUBLE + (p_partkey % 8)::DOUBLE * 250.0::DOUBLE"
_FAULTY = APPS.replace(f"{_POWER} AS power_rating", f"""CASE WHEN p_partkey % 17 = 0 THEN 'NaN'::DOUBLE WHEN p_partkey % 19 = 0 THEN 'Infinity'::DOUBLE
              WHEN p_partkey % 23 = 0 THEN -100.0::DOUBLE WHEN p_partkey % 29 <> 0 THEN {_POWER} END AS power_rating""").replace(
    "CASE WHEN earliest_start < 0", "CASE WHEN power_rating IS NULL THEN 'power_rating has no value' WHEN earliest_start < 0")
_GOOD_PLANS = """plans AS (
  SELECT home_id, CASE home_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'flat' ELSE 'steep' END AS tariff_id,
         (1 + home_id % 2)::INTEGER AS cap
  FROM (SELECT DISTINCT home_id FROM apps) WHERE home_id % 7 <> 0 AND home_id % 11 <> 0 AND home_id % 13 <> 0 AND home_id % 5 <> 0
)"""

SQL["schedule_bad_rows"] = f"""WITH {sched_ctes(_GOOD_PLANS, apps=_FAULTY)}
SELECT a.home_id, CASE WHEN a.home_id % 7 = 0 THEN 'no plan' ELSE coalesce(status.status, 'invalid') END AS status, status.path,
       CASE WHEN a.home_id % 7 <> 0 AND a.home_id % 11 <> 0 THEN (1 + a.home_id % 2)::INTEGER END AS cap, max_on,
       {R('original_cost')} AS original_cost, {R('optimized_cost')} AS optimized_cost
FROM (SELECT DISTINCT home_id FROM apps) a LEFT JOIN status USING (home_id)"""

# Every home's schedule is proven: expected from the rules alone.
SQL["schedule_certificate"] = """
SELECT home_id, 'optimal' AS status, (3 + home_id % 3)::INTEGER AS cap, count(*)::BIGINT AS n_appliances, true AS feasible,
       true AS slack, true AS proven, 0::BIGINT AS gap
FROM (SELECT (p_partkey // 12)::BIGINT AS home_id FROM part) GROUP BY home_id"""

SQL["weather_csv"] = f"""WITH {READINGS},
l AS (SELECT *, row_number() OVER (ORDER BY home_id, ts) AS lid FROM wide),
r AS (SELECT ts AS rts, event_id AS rid, CASE WHEN NOT isnan(value) THEN value END AS temperature
      FROM events WHERE event_type = 'view'),
{_nearest('l', 'r', 1)}
SELECT home_id, ts, {', '.join(r6(c, c) for c in CH)}, {R('r.temperature')} AS temperature, r.rid::DOUBLE AS feed_seq
FROM l JOIN m USING (lid) LEFT JOIN r ON r.rid = m.rid
"""

_NAMED = ["Aggregate"] + [f"Appliance{k}" for k in range(1, 10)]
SQL["channel_choice"] = f"""
WITH k AS (SELECT user_id % 12 AS k, ts, value, event_id FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
w AS (SELECT k, ts, arg_min(value, event_id) AS v FROM k WHERE k BETWEEN 1 AND 10 GROUP BY ALL)
SELECT c.position::INTEGER AS position, c.channel, c.position = 0 AS is_target, c.position < 5 AS is_feature,
       count(v)::BIGINT AS n_values, {R('sum(v)')} AS total
FROM (VALUES {', '.join(f"({i}, '{n}', {i + 1})" for i, n in enumerate(_NAMED))}) c(position, channel, k) LEFT JOIN w USING (k)
GROUP BY ALL
"""

# --- the boosted forecast -------------------------------------------------------

from .catalog import ROUNDS  # noqa: E402
from ..operators.boosting import BoostParams  # noqa: E402
from .oracle_boost import forecast_sql, job_metrics_ctes  # noqa: E402

_FEATURES = [*CH, *TF_INT, *TF_DBL, *FEATURE_NAMES[:-1]]
SQL.update(forecast_sql(ROUNDS, split_ctes(), _FEATURES, r6, TARGET))
SQL["forecast_metrics"] = forecast_sql(BoostParams.rounds, split_ctes(), _FEATURES, r6, TARGET, BoostParams.max_bins)["forecast_metrics"]
_JOB = split_ctes() + ",\n" + re.sub(r"\b(grid|cells)\b", r"hour_\1", sched_ctes())
SQL["household_job"] = (f"{job_metrics_ctes(BoostParams.rounds, _JOB, _FEATURES, r6, BoostParams.max_bins)},\n"
                        + SQL["results_summary"][SQL["results_summary"].index("\ns AS (") + 1:])
