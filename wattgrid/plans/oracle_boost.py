"""SQL (DuckDB dialect) of the boosted forecast: bins, trees and predictions in
one recursive query over the rows, written from the semantics."""

from __future__ import annotations

from collections.abc import Sequence

CELLS, PRIME, UNITS, BINS, DEPTH, SEED = 65536, 2147483647, 20, 64, 6, 42
RATE, LAMBDA, LEAST_GAIN, ROW_SHARE, COLUMN_SHARE = 0.1, 1.0, 1e-6, 0.8, 0.8


def frame_ctes(split_ctes: str, features: Sequence[str], rounded) -> str:
    """``frame``: the split rows with values rounded as the queries show them;
    ``long``: one row per (rid, feature)."""
    shown = ", ".join(rounded(f"{c}::DOUBLE", c) for c in features)
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(features))
    return f"""{split_ctes},
frame AS MATERIALIZED (SELECT row_number() OVER (ORDER BY home_id, ts) AS rid, home_id, ts, split, {rounded('target', 'target')}, {shown} FROM split),
names AS (SELECT * FROM (VALUES {names}) v(feat, feature)),
long AS MATERIALIZED (SELECT rid, split, feat, x FROM (UNPIVOT (SELECT rid, split, {', '.join(features)} FROM frame)
                      ON {', '.join(features)} INTO NAME feature VALUE x) JOIN names USING (feature))"""


def bins_ctes(bins: int = BINS) -> str:
    """``edges (feat, bin, least)`` from the training rows; ``rows``: (rid, split,
    y, draw, bins) with the bins of all features as a list."""
    return f"""spans AS (SELECT feat, min(x) AS lo, max(x) AS hi FROM long WHERE split = 'train' GROUP BY feat),
cells AS (SELECT feat, CASE WHEN hi > lo THEN least({CELLS - 1}, floor((x - lo) / (hi - lo) * {CELLS}.0::DOUBLE)::INT) ELSE 0 END AS cell,
                 count(*) AS n, min(x) AS least
          FROM long JOIN spans USING (feat) WHERE split = 'train' GROUP BY ALL),
bin_ranks AS (SELECT *, (coalesce(sum(n) OVER (PARTITION BY feat ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {bins})
                     // sum(n) OVER (PARTITION BY feat) AS raw FROM cells),
edges AS MATERIALIZED (SELECT feat, bin, min(least) AS least FROM (
           SELECT *, dense_rank() OVER (PARTITION BY feat ORDER BY raw) - 1 AS bin FROM bin_ranks) GROUP BY feat, bin),
row_bins AS (SELECT rid, list(bin ORDER BY feat) AS bins FROM (
             SELECT l.rid, l.feat, coalesce(e.bin, 0) AS bin FROM long l ASOF LEFT JOIN edges e ON l.feat = e.feat AND l.x >= e.least) GROUP BY rid),
label AS (SELECT pow(2, (CASE WHEN max(target) > min(target) THEN ceil(log2(max(target) - min(target))) ELSE 0 END) - {UNITS}) AS unit
          FROM frame WHERE split = 'train'),
rows AS MATERIALIZED (SELECT rid, split, floor(target / unit + 0.5::DOUBLE)::BIGINT AS y,
           CAST('0x' || md5(home_id::VARCHAR || ':' || epoch_us(ts)::VARCHAR)[1:8] AS BIGINT) % {PRIME} AS draw, bins
         FROM frame JOIN row_bins USING (rid), label),
base AS (SELECT floor(sum(y)::DOUBLE / count(*) + 0.5::DOUBLE)::BIGINT AS base FROM rows WHERE split = 'train')"""


def draws_ctes(rounds: int, n: int) -> str:
    """``draws (t, a, b)`` and ``seen (t, feat)`` of each tree."""
    return f"""draws AS MATERIALIZED (SELECT t, 1 + CAST('0x' || md5('{SEED}:' || t)[1:8] AS BIGINT) % {PRIME - 1} AS a,
                 CAST('0x' || md5('{SEED}:' || t)[9:16] AS BIGINT) % {PRIME} AS b FROM range(1, {rounds + 1}) r(t)),
seen AS MATERIALIZED (SELECT t, feat FROM (
          SELECT t, feat, row_number() OVER (PARTITION BY t ORDER BY md5('{SEED}:' || t || ':' || feat), feat) AS k
          FROM draws, range({n}) f(feat)) WHERE k <= {max(1, int(COLUMN_SHARE * n))})"""


def _score(g: str, h: str) -> str:
    return f"(({g}) * unit) * (({g}) * unit) / (({h}) + {LAMBDA!r}::DOUBLE)"


GAIN = f"{_score('gl', 'hl')} + {_score('gt - gl', 'ht - hl')} - {_score('gt', 'ht')}"


def cumulated(source: str) -> str:
    own = "PARTITION BY node, feat"
    return f"""SELECT *, CASE WHEN hl >= 1 AND ht - hl >= 1 THEN {GAIN} END AS gain FROM (
        SELECT *, sum(g) OVER ({own} ORDER BY bin ROWS UNBOUNDED PRECEDING)::BIGINT AS gl, sum(h) OVER ({own} ORDER BY bin ROWS UNBOUNDED PRECEDING)::BIGINT AS hl,
               sum(g) OVER ({own})::BIGINT AS gt, sum(h) OVER ({own})::BIGINT AS ht FROM {source}), label"""


SAMPLED = f"r.split = 'train' AND (r.draw * t.a + t.b) % {PRIME} < {int(ROW_SHARE * PRIME)}"


def boost_cte(rounds: int) -> str:
    """``boost``: kind 0 has each row after each step (``depth`` split steps and
    one leaf step for a tree), kind 1 the splits, kind 2 the leaves."""
    steps = DEPTH + 1
    return f"""boost(s, kind, rid, node, f, feat, bin, gain, h) AS (
  SELECT 0, 0, rid, 1, base, 0, 0, 0.0::DOUBLE, 0::BIGINT FROM rows, base
  UNION ALL
  (WITH cur AS (SELECT s, rid, node, f FROM boost WHERE kind = 0 AND s < {rounds * steps}),
   drawn AS (SELECT cur.s % {steps} AS level, cur.node, cur.f - r.y AS d, r.bins, t.t FROM cur JOIN rows r USING (rid)
             JOIN draws t ON t.t = cur.s // {steps} + 1 WHERE {SAMPLED}),
   hist AS (SELECT node, feat, bin, sum(d)::BIGINT AS g, count(*) AS h FROM (
              SELECT node, d, t, unnest(range(len(bins))) AS feat, unnest(bins) AS bin FROM drawn
              WHERE level < {DEPTH} AND node >= (1 << level)) JOIN seen USING (t, feat) GROUP BY node, feat, bin),
   best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feat, bin) AS k
                           FROM ({cumulated('hist')}) WHERE gain > {LEAST_GAIN!r}) WHERE k = 1),
   leaf AS (SELECT node, count(*) AS h, floor(-{RATE!r}::DOUBLE * sum(d) / (count(*) + {LAMBDA!r}::DOUBLE) + 0.5::DOUBLE)::BIGINT AS v
            FROM drawn WHERE level = {DEPTH} GROUP BY node)
   SELECT cur.s + 1, 0, cur.rid, CASE WHEN cur.s % {steps} = {DEPTH} THEN 1 WHEN best.node IS NULL THEN cur.node
                                      ELSE 2 * cur.node + (r.bins[best.feat + 1] > best.bin)::INT END,
          cur.f + coalesce(leaf.v, 0), 0, 0, 0.0::DOUBLE, 0::BIGINT
   FROM cur JOIN rows r USING (rid) LEFT JOIN best ON best.node = cur.node LEFT JOIN leaf ON leaf.node = cur.node
   UNION ALL SELECT (SELECT max(s) FROM cur), 1, 0, node, 0, feat, bin, gain, ht FROM best
   UNION ALL SELECT (SELECT max(s) FROM cur), 2, 0, node, v, 0, 0, 0.0::DOUBLE, h FROM leaf)
)"""


def job_metrics_ctes(rounds: int, ctes: str, features: Sequence[str], rounded, bins: int = BINS) -> str:
    """``ctes`` (with ``split``) and ``m``: the errors on the test split, one row."""
    parts = [frame_ctes(ctes, features, rounded), bins_ctes(bins), draws_ctes(rounds, len(features)), boost_cte(rounds)]
    return "WITH RECURSIVE " + ",\n".join(parts) + f""",
m AS (SELECT sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
             coalesce(avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100, 0.0) AS mape
      FROM (SELECT x.target AS y_true, b.f * unit AS y_pred FROM boost b JOIN frame x USING (rid), label
            WHERE b.kind = 0 AND b.s = {rounds * (DEPTH + 1)} AND x.split = 'test'))"""


def forecast_sql(rounds: int, split_ctes: str, features: Sequence[str], rounded, last: str, bins: int = BINS) -> dict[str, str]:
    """SQL by query name.  ``rounded(expression, alias)`` rounds; ``last``: the
    column that a last-value forecast takes."""
    steps = DEPTH + 1
    frame = "WITH RECURSIVE " + ",\n".join([frame_ctes(split_ctes, features, rounded), bins_ctes(bins), draws_ctes(rounds, len(features))])
    boost = f"{frame},\n{boost_cte(rounds)}"
    preds = f"""{boost},
preds AS (SELECT b.s // {steps} AS round, x.home_id, x.ts, x.split, x.target AS y_true, b.f * unit AS y_pred
          FROM boost b JOIN frame x USING (rid), label WHERE b.kind = 0 AND b.s % {steps} = 0)"""
    errors = (f"{rounded('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', 'rmse')}, {rounded('avg(abs(y_true - y_pred))', 'mae')}, "
              f"{rounded('coalesce(avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100, 0.0)', 'mape')}")
    last_rmse = f"sqrt(avg((target - {last}) * (target - {last})))"
    return {
        "forecast_gbt": f"""{frame}
SELECT split, count(*)::BIGINT AS n_rows, {rounded(last_rmse, 'last_value_rmse')}, count(*)::BIGINT AS n_scored, {rounded('avg(target)', 'mean_truth')}
FROM frame GROUP BY split""",
        "boost_histogram": f"""{frame},
hist AS (SELECT 1 AS node, feat, bin, sum(base - y)::BIGINT AS g, count(*) AS h FROM (
           SELECT r.y, t.t, unnest(range(len(r.bins))) AS feat, unnest(r.bins) AS bin FROM rows r, draws t WHERE t.t = 1 AND {SAMPLED}), base
         WHERE EXISTS (SELECT 1 FROM seen WHERE seen.t = 1 AND seen.feat = feat) GROUP BY ALL),
own AS (SELECT hist.* FROM hist JOIN seen ON seen.t = 1 AND seen.feat = hist.feat),
cum AS ({cumulated('own')})
SELECT feature, bin::INT AS bin, g, h, {rounded('gain', 'gain')},
       coalesce(gain > {LEAST_GAIN!r} AND row_number() OVER (ORDER BY gain DESC NULLS LAST, feat, bin) = 1, false) AS chosen
FROM cum JOIN names USING (feat)""",
        "forecast_trees": f"""{boost}
SELECT (b.s // {steps} + 1)::INT AS tree, b.node::INT AS node, names.feature, {rounded('e.least', 'threshold')},
       (2 * b.node)::INT AS "left", (2 * b.node + 1)::INT AS "right", NULL::DOUBLE AS value, {rounded('b.gain', 'gain')}, b.h AS cover, (b.bin + 1)::INT AS bin
FROM boost b JOIN names USING (feat) JOIN edges e ON e.feat = b.feat AND e.bin = b.bin + 1 WHERE b.kind = 1
UNION ALL SELECT (b.s // {steps} + 1)::INT, b.node, NULL, NULL, NULL, NULL, {rounded('b.f * unit', 'value')}, NULL, b.h, NULL FROM boost b, label WHERE b.kind = 2
UNION ALL SELECT 0, 1, NULL, NULL, NULL, NULL, {rounded('base * unit', 'value')}, NULL, NULL, NULL FROM base, label""",
        "forecast_predictions": f"""{preds}
SELECT home_id, ts, split, y_true, {rounded('y_pred', 'y_pred')} FROM preds WHERE round = {rounds}""",
        "round_metrics": f"""{preds}
SELECT round::INT AS round, split, {errors} FROM preds GROUP BY round, split""",
        "forecast_metrics": f"""{preds},
m AS (SELECT split, {errors} FROM preds WHERE round = {rounds} GROUP BY split),
l AS (SELECT split, {rounded(last_rmse, 'last_value_rmse')} FROM frame GROUP BY split)
SELECT split, rmse, mae, mape, 'gbt' AS model, last_value_rmse, rmse < last_value_rmse AS beats_last_value FROM m JOIN l USING (split)""",
        "importance_topn": f"""{boost},
per AS (SELECT feature, count(*) AS n_splits, sum(gain) AS total_gain FROM boost JOIN names USING (feat) WHERE kind = 1 GROUP BY feature)
SELECT feature, n_splits, {rounded('total_gain', 'total_gain')}, {rounded('total_gain / n_splits', 'mean_gain')}, {rounded('total_gain / n_splits / sum(total_gain / n_splits) OVER ()', 'importance')}
FROM per ORDER BY total_gain / n_splits / sum(total_gain / n_splits) OVER () DESC, feature LIMIT 20""",
    }
