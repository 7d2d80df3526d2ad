"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string is self-contained over the pre-registered views.  Shared CTE
fragments are assembled here with plain string formatting; every output
column is cast to the same type and rounding as the Spark side
(bigint / double rounded to 6 / timestamp / date / boolean / varchar).
"""

from __future__ import annotations

from tempora.functions.calendar import EASTER_OFFSETS, FIXED_HOLIDAYS
from tempora.functions.rounding import output_round_sql
from tempora.operators.windows import nearest_index
from tempora.plans import features as FT

HOUR_US = 3_600_000_000
DAY_US = 86_400_000_000


def _r(x: str, alias: str | None = None) -> str:
    return f"CAST({output_round_sql('CAST(' + x + ' AS DOUBLE)')} AS DOUBLE) AS {alias or x}"


def _b(x: str, alias: str | None = None) -> str:
    return f"CAST({x} AS BIGINT) AS {alias or x}"


def series_ctes(obs_sql: str, step_us: int, keys: str = "", interpolate: bool = True) -> str:
    """CTEs ``obs, b, grid, al, series`` for a target on the full grid.
    ``obs_sql`` yields ``[keys,] time, load_mw``.  ``keys`` is '' or a
    single key column name."""
    kc = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    grid = (f"SELECT {kc}unnest(generate_series(b.lo, b.hi, INTERVAL {step_us} MICROSECONDS)) AS time "
            f"FROM b" + (f" CROSS JOIN (SELECT DISTINCT {keys} FROM obs) k" if keys else ""))
    ip = "" if not interpolate else f""",
ip AS (SELECT *,
  last_value(CASE WHEN raw IS NOT NULL THEN pos END IGNORE NULLS) OVER (wp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(raw IGNORE NULLS) OVER (wp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN raw IS NOT NULL THEN pos END IGNORE NULLS) OVER (wp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(raw IGNORE NULLS) OVER (wp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM al WINDOW wp AS ({part}ORDER BY pos))"""
    val = ("CASE WHEN raw IS NOT NULL THEN raw WHEN pp IS NOT NULL AND np IS NOT NULL "
           "THEN pv + (nv - pv) * (pos - pp) / (np - pp) END") if interpolate else "raw"
    src = "ip" if interpolate else "al"
    return f"""obs AS ({obs_sql}),
b AS (SELECT min(time) AS lo, max(time) AS hi FROM obs),
grid AS ({grid}),
al AS (SELECT {kc}g.time, (epoch_us(g.time) - epoch_us(b.lo)) // {step_us} AS pos, o.load_mw AS raw
       FROM grid g CROSS JOIN b LEFT JOIN obs o USING ({kc}time)){ip},
series AS (SELECT {kc}time, pos, raw IS NULL AS was_null, {val} AS load_mw FROM {src})"""


HOURLY_OBS = "SELECT date_trunc('hour', ts) AS time, round(sum(value), 6) AS load_mw FROM events GROUP BY 1"
PANEL_OBS = ("SELECT event_type AS series_id, date_trunc('hour', ts) AS time, round(sum(value), 6) AS load_mw "
             "FROM events GROUP BY 1, 2")
DAILY_OBS = "SELECT date_trunc('day', o_orderdate) AS time, round(sum(o_totalprice), 6) AS load_mw FROM orders GROUP BY 1"


def hourly_ctes(interpolate: bool = True) -> str:
    return series_ctes(HOURLY_OBS, HOUR_US, "", interpolate)


# ------------------------------------------------------------- window SQL

def rows_frame(size: int, offset: int = 0) -> str:
    return f"ROWS BETWEEN {offset + size - 1} PRECEDING AND {offset} PRECEDING" if offset else \
        f"ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW"


def roll_sql(agg: str, col: str, size: int, part: str = "", offset: int = 0) -> str:
    w = f"({part}ORDER BY pos {rows_frame(size, offset)})"
    return f"CASE WHEN count({col}) OVER {w} = {size} THEN {agg} OVER {w} END"


def quantile_sql(col: str, q: float, size: int, method: str, part: str = "", offset: int = 0) -> str:
    if method == "linear":
        return roll_sql(f"quantile_cont({col}, {q})", col, size, part, offset)
    idx = nearest_index(size, q) + 1
    w = f"({part}ORDER BY pos {rows_frame(size, offset)})"
    return f"CASE WHEN count({col}) OVER {w} = {size} THEN list_sort(list({col}) OVER {w})[{idx}] END"


def lag_block_sql(value: str = "load_mw", part: str = "", min_lag: int = 0,
                  lags=FT.HOURLY_LAGS, medians=FT.HOURLY_MEDIANS, iqrs=FT.HOURLY_IQRS,
                  iqr_method: str = "nearest") -> list[tuple[str, str]]:
    out = [(f"{value}_lag_{n}", f"lag({value}, {k + min_lag}) OVER ({part}ORDER BY pos)")
           for n, k in lags.items()]
    out += [(f"{value}_rolling_median_{n}", quantile_sql(value, 0.5, w, "linear", part, min_lag))
            for n, w in medians.items()]
    out += [(f"{value}_iqr_{n}",
             f"({quantile_sql(value, 0.75, w, iqr_method, part, min_lag)}) - "
             f"({quantile_sql(value, 0.25, w, iqr_method, part, min_lag)})") for n, w in iqrs.items()]
    return out


def target_cols_sql(value: str = "load_mw", horizons=range(1, 25), part: str = "") -> list[tuple[str, str]]:
    return [(FT.TARGET_PATTERN.format(value=value, h=h), f"lead({value}, {h}) OVER ({part}ORDER BY pos)")
            for h in horizons]


# ------------------------------------------------------------- calendar SQL

def local_sql(t: str) -> str:
    return f"(({t}) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris'"


def holidays_sql(year_lo: str, year_hi: str) -> str:
    """Holiday dates for years in [lo, hi] — Easter by integer arithmetic."""
    fixed = " UNION ALL ".join(f"SELECT y, make_date(y, {m}, {d}) AS hd FROM yrs"
                               for m, d, _ in FIXED_HOLIDAYS)
    mov = " UNION ALL ".join(f"SELECT y, CAST(easter + INTERVAL {o} DAY AS DATE) AS hd FROM ea"
                             for o, _ in EASTER_OFFSETS)
    return f"""yrs AS (SELECT CAST(range AS BIGINT) AS y FROM range(CAST({year_lo} AS BIGINT), CAST({year_hi} AS BIGINT) + 1)),
ez AS (SELECT y, y % 19 AS a, y // 100 AS bb, y % 100 AS c FROM yrs),
ez2 AS (SELECT *, bb // 4 AS d, bb % 4 AS e, (bb + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM ez),
ez3 AS (SELECT *, (bb - f + 1) // 3 AS g FROM ez2),
ez4 AS (SELECT *, (19 * a + bb - d - g + 15) % 30 AS h FROM ez3),
ez5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM ez4),
ez6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM ez5),
ea AS (SELECT y, make_date(y, CAST((h + l - 7 * m + 114) // 31 AS BIGINT),
                           CAST((h + l - 7 * m + 114) % 31 + 1 AS BIGINT)) AS easter FROM ez6),
hol AS (SELECT DISTINCT hd FROM ({fixed} UNION ALL {mov}))"""


def calendar_cols_sql(t: str, suffix: str = "") -> list[tuple[str, str]]:
    lt = local_sql(t)
    return [(f"cal_hour_of_day{suffix}", f"CAST(hour({lt}) AS BIGINT)"),
            (f"cal_day_of_week{suffix}", f"CAST(isodow({lt}) AS BIGINT)"),
            (f"cal_day_of_year{suffix}", f"CAST(dayofyear({lt}) AS BIGINT)"),
            (f"cal_year{suffix}", f"CAST(year({lt}) AS BIGINT)"),
            (f"cal_is_holiday{suffix}", f"(CAST({lt} AS DATE) IN (SELECT hd FROM hol))")]


def _sel(pairs, rounded: bool = True) -> str:
    return ",\n  ".join(_r(e, n) if rounded else f"{e} AS {n}" for n, e in pairs)


# ---------------------------------------------------------------- queries

def sql_time_grid() -> str:
    return (f"WITH {hourly_ctes(False)} SELECT time, "
            f"CAST((epoch_us(time) - epoch_us(b.lo)) // {HOUR_US} AS BIGINT) AS pos FROM grid CROSS JOIN b")


def sql_align_left() -> str:
    return f"WITH {hourly_ctes(False)} SELECT time, {_r('load_mw')} FROM series"


def sql_align_inner() -> str:
    return f"WITH {hourly_ctes(False)} SELECT g.time, {_r('o.load_mw', 'load_mw')} FROM grid g JOIN obs o USING (time)"


def sql_interpolate_linear() -> str:
    return (f"WITH {series_ctes(PANEL_OBS, HOUR_US, 'series_id')} "
            f"SELECT series_id, time, {_r('load_mw')}, was_null FROM series")


def sql_target_series() -> str:
    return f"WITH {hourly_ctes()} SELECT time, {_r('load_mw')}, was_null FROM series"


def sql_lagged_block() -> str:
    return f"WITH {hourly_ctes()} SELECT time, {_r('load_mw')},\n  {_sel(lag_block_sql())} FROM series"


def _pred_range(horizon: int = 24, warmup: int = 168) -> str:
    return f"pos >= {warmup} AND pos <= (SELECT max(pos) FROM series) - {horizon}"


def sql_target_table() -> str:
    return (f"WITH {hourly_ctes()}, t AS (SELECT time AS prediction_time, pos, load_mw, "
            f"{_sel(target_cols_sql(), False)} FROM series) "
            f"SELECT prediction_time, {_r('load_mw')}, "
            f"{_sel([(n, n) for n, _ in target_cols_sql()])} FROM t WHERE {_pred_range()}")


def covariate_ctes() -> str:
    """Wide hourly event counts per type on the full grid, with leads."""
    from tempora.plans.common import EVENT_TYPES
    piv = ", ".join(f"CAST(coalesce(sum(CASE WHEN event_type = '{e}' THEN 1 END), 0) AS DOUBLE) "
                    f"AS weather_n_events_{e}" for e in EVENT_TYPES)
    return f"""cov AS (SELECT date_trunc('hour', ts) AS time, {piv} FROM events GROUP BY 1),
covg AS (SELECT g.time, (epoch_us(g.time) - epoch_us(b.lo)) // {HOUR_US} AS pos,
         {", ".join(f"coalesce(c.weather_n_events_{e}, 0.0) AS weather_n_events_{e}" for e in EVENT_TYPES)}
         FROM grid g CROSS JOIN b LEFT JOIN cov c USING (time))"""


def sql_feature_table(horizons=(1, 24)) -> str:
    from tempora.plans.common import EVENT_TYPES
    lagc = lag_block_sql()
    lead_c = [(f"weather_n_events_{e}_future_{h}h", f"lead(weather_n_events_{e}, {h}) OVER (ORDER BY pos)")
              for e in EVENT_TYPES for h in horizons]
    cal = []
    for name in ["cal_hour_of_day", "cal_day_of_week", "cal_day_of_year", "cal_year", "cal_is_holiday"]:
        for h in horizons:
            cal += [c for c in calendar_cols_sql(f"s.time + INTERVAL {h} HOUR", f"_future_{h}h")
                    if c[0] == f"{name}_future_{h}h"]
    return f"""WITH {hourly_ctes()}, {covariate_ctes()},
{holidays_sql("(SELECT year(lo) - 1 FROM b)", "(SELECT year(hi) + 1 FROM b)")},
lb AS (SELECT time, pos, load_mw, {_sel(lagc, False)} FROM series),
cl AS (SELECT time, {_sel(lead_c, False)} FROM covg)
SELECT s.time AS prediction_time, {_r('s.load_mw', 'load_mw')},
  {_sel([(n, 's.' + n) for n, _ in lagc])},
  {_sel([(n, 'cl.' + n) for n, _ in lead_c])},
  {", ".join(f"{e} AS {n}" for n, e in cal)}
FROM lb s JOIN cl USING (time) WHERE {_pred_range().replace('pos', 's.pos', 2)}"""


def sql_calendar_features() -> str:
    return f"""WITH {hourly_ctes(False)},
{holidays_sql("(SELECT year(" + local_sql("lo") + ") FROM b)", "(SELECT year(" + local_sql("hi") + ") FROM b)")}
SELECT time, {", ".join(f"{e} AS {n}" for n, e in calendar_cols_sql("time"))} FROM grid"""


def _snap_round_even(sql: str) -> str:
    """``round_even(x, d)`` → ``round_even(round(x, 9), d)`` (same snapping as
    the Spark side's ``round_half_even``)."""
    out, i, key = [], 0, "round_even("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k, depth, comma = j + len(key), 1, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = _snap_round_even(sql[j + len(key):comma])
        out.append(sql[i:j] + f"round_even(round({inner}, 9),{sql[comma + 1:k - 1]})")
        i = k


ORACLE = {
    "time_grid": sql_time_grid(),
    "align_left": sql_align_left(),
    "align_inner": sql_align_inner(),
    "interpolate_linear": sql_interpolate_linear(),
    "target_series": sql_target_series(),
    "lagged_block": sql_lagged_block(),
    "target_table": sql_target_table(),
    "feature_table": sql_feature_table(),
    "calendar_features": sql_calendar_features(),
}


# ------------------------------------------------- splits / back-test tables
K, T, GAP, MTRAIN, WARM, MAXH = 5, 72, 24, 240, 168, 24


def split_ctes() -> str:
    """``sp(n, first)`` and the fold bounds table ``fb``."""
    return f"""sp AS (SELECT (SELECT count(*) FROM grid) - {WARM + MAXH} AS n),
fb AS (SELECT CAST(i AS BIGINT) AS fold_idx, sp.n - ({K} - i) * {T} AS test_start,
              sp.n - ({K} - i) * {T} + {T} AS test_end,
              sp.n - ({K} - i) * {T} - {GAP} AS train_end,
              greatest(0, sp.n - ({K} - i) * {T} - {GAP} - {MTRAIN}) AS train_start
       FROM range({K}) r(i) CROSS JOIN sp),
pg AS (SELECT g.time AS prediction_time, (epoch_us(g.time) - epoch_us(b.lo)) // {HOUR_US} - {WARM} AS split_pos
       FROM grid g CROSS JOIN b),
pgr AS (SELECT pg.* FROM pg CROSS JOIN sp WHERE split_pos >= 0 AND split_pos < sp.n)"""


def naive_ctes(horizons=range(1, 25), season: int = 24) -> str:
    hz = ", ".join(str(h) for h in horizons)
    return f"""{hourly_ctes()}, {split_ctes()},
sq AS (SELECT *, ({quantile_sql('load_mw', 0.75, 24, 'nearest')}) - ({quantile_sql('load_mw', 0.25, 24, 'nearest')}) AS iqr FROM series),
nl AS (SELECT s.time AS prediction_time, s.pos - {WARM} AS split_pos, CAST(hz.h AS BIGINT) AS horizon,
          y.load_mw AS load_mw, p.load_mw AS predicted_load_mw,
          p.load_mw - s.iqr AS lower, p.load_mw + s.iqr AS upper
       FROM sq s CROSS JOIN (SELECT unnest([{hz}]) AS h) hz
       JOIN series y ON y.pos = s.pos + hz.h
       JOIN series p ON p.pos = s.pos + hz.h - {season}
       WHERE s.pos >= {WARM} AND s.pos <= (SELECT max(pos) FROM series) - {max(horizons)}),
cv AS (SELECT 'seasonal_naive' AS model, fb.fold_idx, nl.* FROM nl JOIN fb
       ON nl.split_pos >= fb.test_start AND nl.split_pos < fb.test_end)"""


def cv24_ctes() -> str:
    return naive_ctes([24])


def sql_ts_split() -> str:
    return f"""WITH {hourly_ctes(False)}, {split_ctes()}
SELECT prediction_time, fold_idx, 'test' AS role FROM pgr JOIN fb ON split_pos >= test_start AND split_pos < test_end
UNION ALL
SELECT prediction_time, fold_idx, 'train' AS role FROM pgr JOIN fb ON split_pos >= train_start AND split_pos < train_end"""


def sql_fold_report() -> str:
    return f"""WITH t AS ({sql_ts_split()})
SELECT fold_idx, role, CAST(count(*) AS BIGINT) AS n_rows, min(prediction_time) AS first_time,
       max(prediction_time) AS last_time FROM t GROUP BY 1, 2"""


def sql_fold_assign() -> str:
    return f"""WITH {hourly_ctes(False)}, {split_ctes()}
SELECT prediction_time, fold_idx, CAST(split_pos AS BIGINT) AS split_pos FROM pgr
JOIN fb ON split_pos >= test_start AND split_pos < test_end"""


def sql_year_split() -> str:
    return f"""WITH {series_ctes(DAILY_OBS, DAY_US, '', False)},
yb AS (SELECT min(year(time)) AS y0, max(year(time)) AS y1 FROM grid),
t AS (SELECT g.time, CAST(yy.y - yb.y0 - 1 AS BIGINT) AS fold_idx,
             CASE WHEN yy.y = year(g.time) THEN 'test' ELSE 'train' END AS role
      FROM grid g CROSS JOIN yb JOIN (SELECT unnest(generate_series(y0 + 1, y1)) AS y FROM yb) yy
      ON yy.y >= year(g.time))
SELECT fold_idx, role, CAST(count(*) AS BIGINT) AS n_rows, min(time) AS first_time, max(time) AS last_time
FROM t GROUP BY 1, 2"""


def sql_naive_predictions() -> str:
    return f"""WITH {naive_ctes()}
SELECT model, fold_idx, prediction_time, horizon, {_r('load_mw')}, {_r('predicted_load_mw')},
       {_r('lower')}, {_r('upper')} FROM cv"""


def _point_scores_sql(prefix: str = "") -> str:
    return f"""{_r('avg(abs(load_mw - predicted_load_mw) / greatest(abs(load_mw), 2.220446049250313e-16))', prefix + 'mape')},
  {_r('CASE WHEN var_pop(load_mw) * count(load_mw) > 0 THEN 1 - sum((load_mw - predicted_load_mw) ^ 2) / (var_pop(load_mw) * count(load_mw)) END', prefix + 'r2')},
  {_r('avg(abs(load_mw - predicted_load_mw))', prefix + 'mae')},
  {_r('avg((load_mw - predicted_load_mw) ^ 2)', prefix + 'mse')}"""


def sql_score_point() -> str:
    return f"""WITH {cv24_ctes()}
SELECT model, fold_idx, {_point_scores_sql()}, CAST(count(*) AS BIGINT) AS n FROM cv GROUP BY 1, 2"""


def sql_scores_by_horizon() -> str:
    return f"""WITH {naive_ctes()}
SELECT fold_idx, horizon, {_point_scores_sql('test_')}, CAST(count(*) AS BIGINT) AS test_n FROM cv GROUP BY 1, 2"""


def sql_score_deviance() -> str:
    y, p = "load_mw", "predicted_load_mw"
    return f"""WITH {cv24_ctes()},
g AS (SELECT fold_idx,
  sum(2 * (CASE WHEN {y} > 0 THEN {y} * ln({y} / {p}) ELSE 0 END - {y} + {p})) AS dp,
  sum(2 * (ln({p} / {y}) + {y} / {p} - 1)) AS dg,
  avg({y}) AS ybar, min({p}) AS pmin FROM cv GROUP BY 1),
b2 AS (SELECT c.fold_idx,
  sum(2 * (CASE WHEN {y} > 0 THEN {y} * ln({y} / g.ybar) ELSE 0 END - {y} + g.ybar)) AS bp,
  sum(2 * (ln(g.ybar / {y}) + {y} / g.ybar - 1)) AS bg FROM cv c JOIN g USING (fold_idx) GROUP BY 1)
SELECT fold_idx, {_r('CASE WHEN pmin <= 0 THEN NULL WHEN bp <> 0 THEN 1 - dp / bp END', 'd2_poisson')},
  {_r('CASE WHEN pmin <= 0 THEN NULL WHEN bg <> 0 THEN 1 - dg / bg END', 'd2_gamma')}
FROM g JOIN b2 USING (fold_idx)"""


def _pin(y: str, p: str, a: float) -> str:
    return f"({a} * greatest({y} - {p}, 0) + {1 - a} * greatest({p} - {y}, 0))"


def sql_score_pinball() -> str:
    preds = {0.05: "lower", 0.5: "predicted_load_mw", 0.95: "upper"}
    q = ", ".join(f"quantile_cont(load_mw, {a}) AS q{int(a * 100):02d}" for a in preds)
    parts = []
    for a, pc in preds.items():
        tag = f"{int(round(a * 100)):02d}"
        parts.append(_r(f"CASE WHEN sum({_pin('load_mw', 'q' + tag, a)}) <> 0 THEN "
                        f"1 - sum({_pin('load_mw', pc, a)}) / sum({_pin('load_mw', 'q' + tag, a)}) END",
                        f"d2_pinball_{tag}"))
    return f"""WITH {cv24_ctes()}, qs AS (SELECT fold_idx, {q} FROM cv GROUP BY 1)
SELECT fold_idx, {", ".join(parts)} FROM cv JOIN qs USING (fold_idx) GROUP BY 1"""


def sql_coverage_width() -> str:
    return f"""WITH {cv24_ctes()}
SELECT fold_idx, {_r('round_even(avg(CASE WHEN load_mw >= lower AND load_mw <= upper THEN 1.0 ELSE 0.0 END), 4)', 'coverage')},
  {_r('round_even(avg(abs(upper - lower)), 1)', 'mean_width')}, CAST(count(*) AS BIGINT) AS n_samples
FROM cv GROUP BY 1"""


def sql_binned_coverage(n_bins: int = 10) -> str:
    probs = ", ".join(f"CAST({i / n_bins!r} AS DOUBLE)" for i in range(n_bins + 1))
    return f"""WITH {cv24_ctes()},
e AS (SELECT list_sort(list_distinct(quantile_cont(load_mw, [{probs}]))) AS edges FROM cv),
pb AS (SELECT c.load_mw, greatest(len(list_filter(e.edges, lambda v: v < c.load_mw)) - 1, 0) AS pbin FROM cv c CROSS JOIN e),
bd AS (SELECT pbin, min(load_mw) AS bin_left, max(load_mw) AS bin_right FROM pb GROUP BY 1),
bl AS (SELECT list_sort(list(bin_left)) AS lefts FROM bd),
fr AS (SELECT c.*, len(list_filter(bl.lefts, lambda v: v <= c.load_mw)) - 1 AS bin FROM cv c CROSS JOIN bl),
g AS (SELECT fold_idx, bin, round_even(avg(CASE WHEN load_mw >= lower AND load_mw <= upper THEN 1.0 ELSE 0.0 END), 4) AS coverage,
             round_even(avg(abs(upper - lower)), 1) AS mean_width, count(*) AS n_samples FROM fr GROUP BY 1, 2),
bk AS (SELECT bin_left, bin_right, row_number() OVER (ORDER BY bin_left) - 1 AS rk FROM bd)
SELECT {_r('bin_left')}, {_r('bin_right')}, {_r('(bin_left + bin_right) / 2', 'bin_center')}, fold_idx,
  {_r('coverage')}, {_r('mean_width')}, CAST(n_samples AS BIGINT) AS n_samples
FROM g JOIN bk ON g.bin = bk.rk"""


def lorenz_ctes() -> str:
    return f"""{cv24_ctes()},
lz AS (SELECT 'Model' AS model, fold_idx, prediction_time, load_mw, predicted_load_mw AS ord FROM cv
       UNION ALL SELECT 'Oracle', fold_idx, prediction_time, load_mw, load_mw FROM cv),
rk AS (SELECT *, row_number() OVER w AS i,
          sum(load_mw) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
          count(*) OVER (PARTITION BY model, fold_idx) AS n,
          sum(load_mw) OVER (PARTITION BY model, fold_idx) AS tot
       FROM lz WINDOW w AS (PARTITION BY model, fold_idx ORDER BY ord, prediction_time)),
rk2 AS (SELECT *, cum / tot AS co, lag(cum / tot) OVER w2 AS prev, lead(cum / tot) OVER w2 AS nxt
        FROM rk WINDOW w2 AS (PARTITION BY model, fold_idx ORDER BY i)),
gi AS (SELECT model, fold_idx, 1 - 2 * sum(CASE WHEN prev IS NOT NULL THEN (co + prev) / 2 / n END) AS gini_index
       FROM rk2 GROUP BY 1, 2)"""


def sql_lorenz_curve(n_samples: int = 500) -> str:
    return f"""WITH {lorenz_ctes()},
pts AS (SELECT model, fold_idx, n, j.j / {n_samples - 1} AS x FROM (SELECT DISTINCT model, fold_idx, n FROM rk2)
        CROSS JOIN range({n_samples}) j(j)),
pi AS (SELECT *, least(greatest(floor(x * n), 1), n) AS i FROM pts)
SELECT pi.model, pi.fold_idx, {_r('pi.x', 'cum_population')},
  {_r('CASE WHEN pi.x * pi.n <= 1 THEN r.co WHEN pi.i >= pi.n THEN r.co ELSE r.co + (r.nxt - r.co) * (pi.x * pi.n - pi.i) END', 'cum_observed')}
FROM pi JOIN rk2 r ON r.model = pi.model AND r.fold_idx = pi.fold_idx AND r.i = pi.i"""


def sql_gini() -> str:
    return f"WITH {lorenz_ctes()} SELECT model, fold_idx, {_r('gini_index')} FROM gi"


def sql_lorenz_summary(n_samples: int = 500) -> str:
    return f"""WITH {lorenz_ctes()},
s AS (SELECT model, avg(gini_index) AS gm, stddev_samp(gini_index) AS gs, var_pop(gini_index) AS vp,
             count(*) * {n_samples} AS m FROM gi GROUP BY 1)
SELECT model, {_r('gm', 'gini_mean')}, {_r('gs', 'gini_std')}, {_r('sqrt(vp * m / (m - 1))', 'gini_std_rows')},
  printf('%s (Gini: %s +/- %s)', model, printf('%.4f', gm), printf('%.4f', sqrt(vp * m / (m - 1)))) AS model_label
FROM s"""


def fold_label_sql(src: str, base: int = 0) -> str:
    return (f"SELECT fold_idx, printf('#%d - %s to %s', fold_idx + {base}, strftime(min(prediction_time), '%Y-%m-%d'), "
            f"strftime(max(prediction_time), '%Y-%m-%d')) AS fold_label FROM {src} GROUP BY 1")


def nearest_q_sql(col: str, q: float) -> str:
    return f"list_sort(list({col}))[CAST(floor((count({col}) - 1) * {q} + 0.5) AS BIGINT) + 1]"


def _reliability(kind: str, n_bins: int = 10) -> str:
    probs = ", ".join(f"CAST({i / (n_bins - 1)!r} AS DOUBLE)" for i in range(n_bins))
    ycol = (_r("avg(load_mw)", "mean_load_mw") if kind == "mean"
            else _r(nearest_q_sql("load_mw", 0.5), "quantile_of_load_mw"))
    return f"""WITH {cv24_ctes()},
ed AS (SELECT fold_idx, quantile_cont(predicted_load_mw, [{probs}]) AS edges FROM cv GROUP BY 1),
bn AS (SELECT c.*, CAST(len(list_filter(ed.edges, lambda v: v < c.predicted_load_mw)) AS BIGINT) AS bin_idx
       FROM cv c JOIN ed USING (fold_idx)),
fl AS ({fold_label_sql('cv')})
SELECT bn.fold_idx, bin_idx, {_r('avg(predicted_load_mw)', 'mean_predicted_load_mw')}, {ycol}, any_value(fl.fold_label) AS fold_label
FROM bn JOIN fl USING (fold_idx) GROUP BY 1, 2"""


def sql_residuals() -> str:
    return f"""WITH {cv24_ctes()}, fl AS ({fold_label_sql('cv', 1)})
SELECT fold_idx, prediction_time, {_r('load_mw')}, {_r('predicted_load_mw')},
  {_r('predicted_load_mw - load_mw', 'residual')}, fold_label FROM cv JOIN fl USING (fold_idx)"""


def _residuals_binned(name: str, ext: str) -> str:
    return f"""WITH {cv24_ctes()}, r AS (SELECT fold_idx, {ext}(prediction_time) AS {name}, predicted_load_mw - load_mw AS residual FROM cv)
SELECT fold_idx, CAST({name} AS BIGINT) AS {name}, {_r('round_even(avg(residual), 1)', 'mean_residual')},
  {_r('round_even(' + nearest_q_sql('residual', 0.25) + ', 1)', 'q25_residual')},
  {_r('round_even(' + nearest_q_sql('residual', 0.75) + ', 1)', 'q75_residual')}
FROM r GROUP BY 1, 2"""


def _tail_sql(n: int, cols: str) -> str:
    return f"""WITH {cv24_ctes()}, mx AS (SELECT fold_idx, max(prediction_time) AS m FROM cv GROUP BY 1)
SELECT {cols} FROM cv JOIN mx USING (fold_idx) WHERE prediction_time > m - INTERVAL {n} HOUR"""


def sql_horizon_forecast(past: int = 168) -> str:
    return f"""WITH {naive_ctes()},
t0 AS (SELECT (SELECT test_start FROM fb WHERE fold_idx = {K - 1}) + {WARM} AS p0)
SELECT 'past' AS kind, time, {_r('load_mw', 'value')} FROM series, t0 WHERE pos >= p0 - {past} AND pos <= p0
UNION ALL
SELECT 'future', time, {_r('load_mw', 'value')} FROM series, t0 WHERE pos > p0 AND pos <= p0 + {MAXH}
UNION ALL
SELECT 'forecast', prediction_time + horizon * INTERVAL 1 HOUR, {_r('predicted_load_mw', 'value')} FROM cv, t0
WHERE split_pos = p0 - {WARM}"""


def fold_scores_cte() -> str:
    return f"""{cv24_ctes()}, fs AS (SELECT fold_idx, {_point_scores_sql('test_')} FROM cv GROUP BY 1),
ul AS (UNPIVOT fs ON test_mape, test_r2, test_mae, test_mse INTO NAME metric VALUE value)"""


def sql_unpivot_scores() -> str:
    return f"WITH {fold_scores_cte()} SELECT fold_idx, metric, {_r('value')} FROM ul"


def sql_cv_mean_scores() -> str:
    return f"WITH {fold_scores_cte()} SELECT metric, {_r('avg(value)', 'mean_value')} FROM ul GROUP BY 1"


def sql_union_folds() -> str:
    ps = f"""{_r('avg(abs(load_mw - predicted_load_mw) / greatest(abs(load_mw), 2.220446049250313e-16))', 'mape')},
  {_r('CASE WHEN var_pop(load_mw) * count(load_mw) > 0 THEN 1 - sum((load_mw - predicted_load_mw) ^ 2) / (var_pop(load_mw) * count(load_mw)) END', 'r2')},
  CAST(count(*) AS BIGINT) AS n"""
    return f"""WITH {naive_ctes([24])},
te AS (SELECT fb.fold_idx, 'test' AS role, nl.* FROM nl JOIN fb ON split_pos >= test_start AND split_pos < test_end),
tr AS (SELECT fb.fold_idx, 'train' AS role, nl.* FROM nl JOIN fb ON split_pos >= train_start AND split_pos < train_end)
SELECT fold_idx, role, {ps} FROM tr GROUP BY 1, 2
UNION ALL
SELECT fold_idx, role, {ps} FROM te GROUP BY 1, 2"""


def sql_score_spread() -> str:
    return f"""WITH {naive_ctes()}, s AS (SELECT fold_idx, horizon, {_point_scores_sql('test_')} FROM cv GROUP BY 1, 2),
ul AS (UNPIVOT (SELECT fold_idx, horizon, test_mape, test_r2 FROM s) ON test_mape, test_r2 INTO NAME metric VALUE value)
SELECT metric, horizon, {_r('min(value)', 'min')}, {_r('quantile_cont(value, 0.25)', 'q25')},
  {_r('quantile_cont(value, 0.5)', 'median')}, {_r('quantile_cont(value, 0.75)', 'q75')}, {_r('max(value)', 'max')}
FROM ul GROUP BY 1, 2"""


def sql_score_integrated() -> str:
    return f"""WITH {naive_ctes()}, s AS (SELECT fold_idx, horizon, avg(abs(load_mw - predicted_load_mw)) AS mae,
       avg((load_mw - predicted_load_mw) ^ 2) AS mse FROM cv GROUP BY 1, 2)
SELECT fold_idx, {_r('avg(mae)', 'integrated_mae')}, {_r('avg(mse)', 'integrated_mse')},
  {_r('min(mae)', 'min_mae')}, {_r('max(mae)', 'max_mae')} FROM s GROUP BY 1"""


def sql_mae_by_horizon() -> str:
    return f"""WITH {naive_ctes()}
SELECT model, horizon, {_r('avg(abs(load_mw - predicted_load_mw))', 'mae')} FROM cv
WHERE load_mw IS NOT NULL AND predicted_load_mw IS NOT NULL GROUP BY 1, 2"""


def sql_conformal_adjust(alpha: float = 0.1) -> str:
    return f"""WITH {cv24_ctes()},
sc AS (SELECT fold_idx, greatest(lower - load_mw, load_mw - upper) AS score FROM cv),
qh AS (SELECT fold_idx + 1 AS fold_idx,
         list_sort(list(score))[CAST(least(ceil((count(*) + 1) * {1 - alpha}), count(*)) AS BIGINT)] AS q_hat
       FROM sc GROUP BY 1)
SELECT fold_idx, {_r('any_value(q_hat)', 'q_hat')},
  {_r('round_even(avg(CASE WHEN load_mw >= lower AND load_mw <= upper THEN 1.0 ELSE 0.0 END), 4)', 'coverage_raw')},
  {_r('round_even(avg(CASE WHEN load_mw >= lower - q_hat AND load_mw <= upper + q_hat THEN 1.0 ELSE 0.0 END), 4)', 'coverage_adjusted')},
  {_r('round_even(avg(upper - lower), 1)', 'width_raw')},
  {_r('round_even(avg((upper + q_hat) - (lower - q_hat)), 1)', 'width_adjusted')}
FROM cv JOIN qh USING (fold_idx) GROUP BY 1"""


ORACLE.update({
    "ts_split": sql_ts_split(),
    "fold_report": sql_fold_report(),
    "fold_assign": sql_fold_assign(),
    "year_split": sql_year_split(),
    "naive_predictions": sql_naive_predictions(),
    "score_point": sql_score_point(),
    "scores_by_horizon": sql_scores_by_horizon(),
    "score_deviance": sql_score_deviance(),
    "score_pinball": sql_score_pinball(),
    "coverage_width": sql_coverage_width(),
    "binned_coverage": sql_binned_coverage(),
    "lorenz_curve": sql_lorenz_curve(),
    "gini": sql_gini(),
    "lorenz_summary": sql_lorenz_summary(),
    "reliability_mean": _reliability("mean"),
    "reliability_quantile": _reliability("quantile"),
    "residuals": sql_residuals(),
    "residuals_by_hour": _residuals_binned("hour_of_day", "hour"),
    "residuals_by_month": _residuals_binned("month_of_year", "month"),
    "interval_table": _tail_sql(240, f"fold_idx, prediction_time, {_r('load_mw')}, {_r('predicted_load_mw')}, {_r('lower')}, {_r('upper')}"),
    "tail_per_fold": _tail_sql(24, f"fold_idx, prediction_time, {_r('load_mw')}"),
    "horizon_forecast": sql_horizon_forecast(),
    "unpivot_scores": sql_unpivot_scores(),
    "cv_mean_scores": sql_cv_mean_scores(),
    "union_folds": sql_union_folds(),
    "score_spread": sql_score_spread(),
    "score_integrated": sql_score_integrated(),
    "mae_by_horizon": sql_mae_by_horizon(),
    "conformal_adjust": sql_conformal_adjust(),
})


ORACLE = {k: _snap_round_even(v) for k, v in ORACLE.items()}
