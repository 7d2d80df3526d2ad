"""DuckDB SQL twins for :mod:`tempora.plans.queries_ops`."""

from __future__ import annotations

from tempora.plans import oracle as O
from tempora.plans.common import RETURN_FLAGS
from tempora.sources.tables import EXOGENOUS_VARS

_r, _sel = O._r, O._sel
HOUR_US, DAY_US = O.HOUR_US, O.DAY_US
VARS = [v.removeprefix("l_") for v in EXOGENOUS_VARS]


def panel_ctes(interpolate: bool = True) -> str:
    return O.series_ctes(O.PANEL_OBS, HOUR_US, "series_id", interpolate)


def exo_wide_cte(inner: bool = True) -> str:
    cols = ", ".join(f"avg(CASE WHEN lower(l_returnflag) = '{c}' THEN l_{v} END) AS weather_{v}_{c}"
                     for v in VARS for c in RETURN_FLAGS)
    having = f" HAVING count(DISTINCT lower(l_returnflag)) = {len(RETURN_FLAGS)}" if inner else ""
    return f"wide AS (SELECT date_trunc('day', l_shipdate) AS time, {cols} FROM lineitem GROUP BY 1{having})"


WIDE_COLS = [f"weather_{v}_{c}" for v in VARS for c in RETURN_FLAGS]

SQL = {}

SQL["scan_parquet"] = f"SELECT CAST(event_id AS BIGINT) AS event_id, ts, event_type, {_r('value')}, 'events' AS source FROM events"

SQL["literal_table"] = f"""WITH names(city, city_name) AS (VALUES ('a', 'Alpha'), ('n', 'Nord'), ('r', 'Rive')),
d AS (SELECT date_trunc('day', l_shipdate) AS time, lower(l_returnflag) AS city, avg(l_quantity) AS q
      FROM lineitem GROUP BY 1, 2)
SELECT city, CAST(count(*) AS BIGINT) AS n_days, {_r('avg(q)', 'mean_quantity')}, any_value(city_name) AS city_name
FROM d JOIN names USING (city) GROUP BY 1"""

SQL["explode_payload"] = f"""WITH obs AS ({O.HOURLY_OBS}),
days AS (SELECT DISTINCT date_trunc('day', time) AS d FROM obs),
g AS (SELECT d + INTERVAL (h) HOUR AS time FROM days CROSS JOIN range(24) r(h))
SELECT g.time, {_r('obs.load_mw', 'load_mw')} FROM g LEFT JOIN obs USING (time)"""

SQL["scan_load_csv"] = f"WITH {O.hourly_ctes(False)} SELECT time, {_r('load_mw')} FROM series"
SQL["sink_idempotent"] = f"WITH {O.hourly_ctes()} SELECT time, {_r('load_mw')} FROM series"
SQL["save_load_features"] = O.sql_feature_table()

SQL["prediction_grid"] = f"""WITH {O.hourly_ctes(False)}
SELECT unnest(generate_series(lo + INTERVAL 168 HOUR, hi - INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS prediction_time FROM b"""

SQL["preview_head"] = f"WITH {O.hourly_ctes()} SELECT time, {_r('load_mw')} FROM series ORDER BY time LIMIT 100"

SQL["star_covariates"] = f"WITH {exo_wide_cte()} SELECT time, {_sel([(c, c) for c in WIDE_COLS])} FROM wide"


def _exo_leads(hs=(1, 7)) -> str:
    leads = [(f"{c}_future_{h}h", f"lead({c}, {h}) OVER (ORDER BY g.time)") for c in WIDE_COLS for h in hs]
    return f"""WITH {exo_wide_cte()},
b AS (SELECT min(time) AS lo, max(time) AS hi FROM wide),
g AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS time FROM b),
al AS (SELECT g.time, {", ".join(f"wide.{c}" for c in WIDE_COLS)}, {", ".join(f"{e} AS {n}" for n, e in leads)}
       FROM g LEFT JOIN wide USING (time))
SELECT al.time, {_sel([(n, 'al.' + n) for n, _ in leads])}, {_sel([(c, 'wide.' + c) for c in WIDE_COLS])}
FROM al JOIN wide USING (time)"""


SQL["exogenous_wide"] = _exo_leads()
SQL["rename_covariates"] = (f"WITH {exo_wide_cte()} SELECT time, "
                            + _sel([(c.replace('weather_', 'cov_') + '_daily', c) for c in WIDE_COLS]) + " FROM wide")
SQL["select_glob"] = (f"WITH {exo_wide_cte()} SELECT time, "
                      + _sel([(c, c) for c in WIDE_COLS if c.startswith('weather_quantity_')]) + " FROM wide")
SQL["select_glob_diff"] = (f"WITH {exo_wide_cte()} SELECT time, "
                           + _sel([(c, c) for c in WIDE_COLS if not c.endswith('_r')]) + " FROM wide")

SQL["null_audit"] = f"WITH {panel_ctes(False)} SELECT series_id, time FROM series WHERE load_mw IS NULL"

SQL["filter_open_interval"] = f"""WITH {O.hourly_ctes()}
SELECT time, {_r('load_mw')} FROM series, b WHERE time > b.lo + INTERVAL 100 HOUR AND time < b.lo + INTERVAL 200 HOUR"""
SQL["filter_closed_right"] = f"""WITH {O.hourly_ctes()}
SELECT time, {_r('load_mw')} FROM series, b WHERE time > b.lo + INTERVAL 100 HOUR AND time <= b.lo + INTERVAL 200 HOUR"""

SQL["high_iqr_dates"] = f"""WITH {O.hourly_ctes()},
lb AS (SELECT time, ({O.quantile_sql('load_mw', 0.75, 168, 'nearest')}) - ({O.quantile_sql('load_mw', 0.25, 168, 'nearest')}) AS iqr FROM series),
thr AS (SELECT quantile_cont(iqr, 0.9) AS t FROM lb)
SELECT DISTINCT CAST(time AS DATE) AS date FROM lb, thr WHERE iqr > thr.t"""

SQL["holiday_flag"] = f"""WITH {O.series_ctes(O.DAILY_OBS, DAY_US, '', False)},
{O.holidays_sql("(SELECT min(year(" + O.local_sql("time") + ")) FROM grid)", "(SELECT max(year(" + O.local_sql("time") + ")) FROM grid)")}
SELECT time, (CAST({O.local_sql('time')} AS DATE) IN (SELECT hd FROM hol)) AS is_holiday FROM grid"""

SQL["join_inner"] = f"""WITH {O.hourly_ctes(False)}, {O.covariate_ctes()}
SELECT time, {_r('obs.load_mw', 'load_mw')}, {_sel([(f'weather_n_events_{e}', f'covg.weather_n_events_{e}') for e in ['click', 'error', 'purchase', 'signup', 'view']])}
FROM obs JOIN covg USING (time)"""

SQL["join_renamed_key"] = f"""WITH {O.hourly_ctes()},
lb AS (SELECT time, load_mw, lag(load_mw, 24) OVER (ORDER BY pos) AS load_mw_lag_1d,
              lag(load_mw, 168) OVER (ORDER BY pos) AS load_mw_lag_1w FROM series),
pg AS (SELECT unnest(generate_series(lo + INTERVAL 168 HOUR, hi - INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS prediction_time FROM b)
SELECT prediction_time, {_r('load_mw')}, {_r('load_mw_lag_1d')}, {_r('load_mw_lag_1w')}
FROM pg JOIN lb ON pg.prediction_time = lb.time"""

SQL["join_left_composite"] = f"""WITH {panel_ctes(False)}
SELECT series_id, time, CAST(pos AS BIGINT) AS pos, {_r('obs.load_mw', 'observed')} FROM series LEFT JOIN obs USING (series_id, time)"""

SQL["join_back_agg"] = f"""WITH {O.cv24_ctes()},
r AS (SELECT fold_idx, prediction_time, predicted_load_mw - load_mw AS residual FROM cv),
m AS (SELECT fold_idx, avg(residual) AS fm FROM r GROUP BY 1)
SELECT fold_idx, prediction_time, {_r('residual')}, {_r('fm', 'fold_mean_residual')}, {_r('residual - fm', 'centered_residual')}
FROM r JOIN m USING (fold_idx)"""

SQL["concat_quantiles"] = f"""WITH {O.cv24_ctes()}
SELECT fold_idx, prediction_time, {_r('lower', 'predicted_load_mw_q05')}, {_r('predicted_load_mw', 'predicted_load_mw_q50')},
  {_r('upper', 'predicted_load_mw_q95')}, {_r('load_mw')} FROM cv"""

SQL["asof_available"] = f"""WITH {O.hourly_ctes(False)},
ty AS (SELECT DISTINCT event_type AS series_id FROM events),
g AS (SELECT ty.series_id, grid.time AS prediction_time FROM ty CROSS JOIN grid),
e AS (SELECT event_type AS series_id, ts + INTERVAL 3 HOUR AS t, event_id, value FROM events),
u AS (SELECT series_id, t, 0 AS kind, event_id AS tie, {{'t': t, 'tie': event_id, 'value': value}} AS rec, NULL::TIMESTAMP AS prediction_time FROM e
      UNION ALL SELECT series_id, prediction_time, 1, NULL, NULL, prediction_time FROM g),
c AS (SELECT *, last_value(rec IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY t, kind, tie
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lastrec FROM u)
SELECT series_id, prediction_time, lastrec.t AS available_at, {_r('lastrec.value', 'value')},
  CAST(lastrec.tie AS BIGINT) AS event_id FROM c WHERE kind = 1"""

LI = "lineitem"
SQL["group_mean"] = f"""SELECT l_returnflag, l_linestatus, {_r('avg(l_quantity)', 'mean_quantity')}, {_r('avg(l_extendedprice)', 'mean_price')}
FROM lineitem GROUP BY 1, 2"""
SQL["group_std"] = f"""SELECT l_returnflag, l_linestatus, {_r('stddev_samp(l_quantity)', 'std_quantity')}, {_r('stddev_samp(l_extendedprice)', 'std_price')}
FROM lineitem GROUP BY 1, 2"""
SQL["group_quantile_linear"] = ("SELECT l_returnflag, " + ", ".join(
    _r(f"quantile_cont(l_extendedprice, {q})", f"q{int(q * 100)}") for q in (0.1, 0.5, 0.9)) + " FROM lineitem GROUP BY 1")
SQL["group_quantile_nearest"] = ("SELECT l_returnflag, " + ", ".join(
    _r(O.nearest_q_sql("l_extendedprice", q), f"q{int(q * 100)}") for q in (0.1, 0.5, 0.9)) + " FROM lineitem GROUP BY 1")
SQL["five_number_summary"] = f"""SELECT l_returnflag, {_r('min(l_extendedprice)', 'min')}, {_r('quantile_cont(l_extendedprice, 0.25)', 'q25')},
  {_r('quantile_cont(l_extendedprice, 0.5)', 'median')}, {_r('quantile_cont(l_extendedprice, 0.75)', 'q75')}, {_r('max(l_extendedprice)', 'max')}
FROM lineitem GROUP BY 1"""

PROF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_long = f"ul AS (UNPIVOT (SELECT {', '.join(PROF)} FROM lineitem) ON {', '.join(PROF)} INTO NAME \"column\" VALUE value)"
SQL["profile_columns"] = f"""WITH {_long}
SELECT "column", CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
  CAST(count(DISTINCT value) AS BIGINT) AS n_distinct, {_r('avg(value)', 'mean')}, {_r('stddev_samp(value)', 'std')},
  {_r('min(value)', 'min')}, {_r('quantile_cont(value, 0.25)', 'q25')}, {_r('quantile_cont(value, 0.5)', 'median')},
  {_r('quantile_cont(value, 0.75)', 'q75')}, {_r('max(value)', 'max')}
FROM ul GROUP BY 1"""
SQL["profile_top_values"] = f"""WITH {_long}, vc AS (SELECT "column", value, count(*) AS n FROM ul WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC) AS rank FROM vc)
SELECT "column", CAST(rank AS BIGINT) AS rank, {_r('value')}, CAST(n AS BIGINT) AS n FROM r WHERE rank <= 5"""
SQL["profile_histogram"] = f"""WITH {_long}, mm AS (SELECT "column", min(value) AS lo, max(value) AS hi FROM ul GROUP BY 1)
SELECT "column", CAST(least(floor((value - lo) / (hi - lo) * 10), 9) AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n
FROM ul JOIN mm USING ("column") GROUP BY 1, 2"""

P = "PARTITION BY series_id "


def _panel_cols(cols) -> str:
    return f"WITH {panel_ctes()} SELECT series_id, time, {_sel(cols)} FROM series"


SQL["lag_features"] = _panel_cols([(f"load_mw_lag_{k}", f"lag(load_mw, {k}) OVER ({P}ORDER BY pos)") for k in (1, 2, 24)])
SQL["lead_features"] = _panel_cols([(f"load_mw_lead_{k}", f"lead(load_mw, {k}) OVER ({P}ORDER BY pos)") for k in (1, 24)])
SQL["rolling_median"] = _panel_cols([("rolling_median_24", O.quantile_sql("load_mw", 0.5, 24, "linear", P))])
SQL["rolling_quantile"] = _panel_cols([("rolling_q90_nearest", O.quantile_sql("load_mw", 0.9, 24, "nearest", P)),
                                       ("rolling_q90_linear", O.quantile_sql("load_mw", 0.9, 24, "linear", P))])
SQL["rolling_iqr"] = _panel_cols([("iqr_168", f"({O.quantile_sql('load_mw', 0.75, 168, 'nearest', P)}) - "
                                   f"({O.quantile_sql('load_mw', 0.25, 168, 'nearest', P)})")])

LAGS = [(f"lag{k}", f"lag(load_mw, {k}) OVER ({P}ORDER BY pos)") for k in range(1, 31)]
RMEAN = [("rolling_mean_lag1_window_size15", O.roll_sql("avg(load_mw)", "load_mw", 15, P, 1))]
RSTD = [("rolling_std_lag1_window_size15", O.roll_sql("stddev_samp(load_mw)", "load_mw", 15, P, 1))]
RMM = [("rolling_max_lag15_window_size15", O.roll_sql("max(load_mw)", "load_mw", 15, P, 15)),
       ("rolling_min_lag15_window_size15", O.roll_sql("min(load_mw)", "load_mw", 15, P, 15))]
SQL["lag_block"] = _panel_cols(LAGS)
SQL["rolling_mean_lagged"] = _panel_cols(RMEAN)
SQL["rolling_std_lagged"] = _panel_cols(RSTD)
SQL["rolling_minmax_lagged"] = _panel_cols(RMM)
_all = LAGS + RMEAN + RSTD + RMM
SQL["lag_matrix"] = f"""WITH {panel_ctes()}, m AS (SELECT series_id, time, load_mw AS y, {_sel(_all, False)} FROM series)
SELECT series_id, time, {_r('y')}, {_sel([(n, n) for n, _ in _all])} FROM m
WHERE y IS NOT NULL AND {" AND ".join(f"{n} IS NOT NULL" for n, _ in _all)}"""
SQL["difference"] = _panel_cols([("diff_1", f"load_mw - lag(load_mw, 1) OVER ({P}ORDER BY pos)"),
                                 ("diff_24", f"load_mw - lag(load_mw, 24) OVER ({P}ORDER BY pos)")])

SUPP_OBS = ("SELECT l_suppkey AS series_id, date_trunc('day', l_shipdate) AS time, round(sum(l_quantity), 6) AS load_mw "
            "FROM lineitem GROUP BY 1, 2")
_dl = O.lag_block_sql("load_mw", P, 0, {"1d": 1, "2d": 2, "7d": 7}, {"7d": 7, "28d": 28}, {"7d": 7, "28d": 28})
SQL["panel_lagged_block"] = (f"WITH {O.series_ctes(SUPP_OBS, DAY_US, 'series_id')} SELECT series_id, time, "
                             f"{_r('load_mw')}, {_sel(_dl)} FROM series")

SQL["holdout_split"] = f"""WITH {panel_ctes()}, c AS (SELECT CAST(floor((SELECT count(DISTINCT time) FROM grid) * 0.8) AS BIGINT) AS cut)
SELECT series_id, CASE WHEN pos >= cut THEN 'test' ELSE 'train' END AS role, CAST(count(*) AS BIGINT) AS n_rows,
  min(time) AS first_time, max(time) AS last_time FROM series, c GROUP BY 1, 2"""

SQL["calendar_fields"] = f"""SELECT CAST(event_id AS BIGINT) AS event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) AS BIGINT) AS iso_weekday,
  CAST(dayofyear(ts) AS BIGINT) AS day_of_year, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
  CAST(ts AS DATE) AS date, strftime(ts, '%Y-%m-%d') AS date_text, CAST(hour({O.local_sql('ts')}) AS BIGINT) AS local_hour FROM events"""

SQL["string_parse"] = f"""WITH {O.hourly_ctes(False)}
SELECT time, strftime(time, '%d.%m.%Y %H:%M') || ' - ' || strftime(time + INTERVAL 1 HOUR, '%d.%m.%Y %H:%M') AS text,
  strptime(strftime(time, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M') AS parsed FROM grid"""

SQL["label_format"] = """SELECT event_type, upper(event_type[1]) || lower(event_type[2:]) AS title, upper(event_type) AS upper,
  replace(event_type, '_', ' ') AS replaced,
  printf('%s: %.4f (n=%d)', upper(event_type[1]) || lower(event_type[2:]), avg(value), count(*)) AS label
FROM events GROUP BY 1"""

SQL["digitize"] = f"""SELECT CAST(len(list_filter([0.0, 50000.0, 100000.0, 200000.0, 300000.0], lambda x: x <= o_totalprice)) - 1 AS BIGINT) AS bin,
  CAST(count(*) AS BIGINT) AS n, {_r('min(o_totalprice)', 'min_price')} FROM orders GROUP BY 1"""


def _feature_table_past() -> str:
    s = O.sql_feature_table()
    s = s.replace("_future_", "_past_").replace("lead(weather", "lag(weather")
    s = s.replace("s.time + INTERVAL 1 HOUR", "s.time - INTERVAL 1 HOUR").replace(
        "s.time + INTERVAL 24 HOUR", "s.time - INTERVAL 24 HOUR")
    return s


SQL["feature_table_past"] = _feature_table_past()


def _feature_table_daily() -> str:
    lagc = O.lag_block_sql("load_mw", "", 0, {"1d": 1, "2d": 2, "7d": 7}, {"7d": 7, "28d": 28}, {"7d": 7, "28d": 28})
    hs = (1, 7)
    lead_c = [(f"{c}_future_{h}h", f"lead({c}, {h}) OVER (ORDER BY g.time)") for c in WIDE_COLS for h in hs]
    cal = []
    for name in ["cal_hour_of_day", "cal_day_of_week", "cal_day_of_year", "cal_year", "cal_is_holiday"]:
        for h in hs:
            cal += [c for c in O.calendar_cols_sql(f"s.time + INTERVAL {h} DAY", f"_future_{h}h")
                    if c[0] == f"{name}_future_{h}h"]
    return f"""WITH {O.series_ctes(O.DAILY_OBS, DAY_US)}, {exo_wide_cte(False)},
{O.holidays_sql("(SELECT year(lo) - 1 FROM b)", "(SELECT year(hi) + 1 FROM b)")},
cl AS (SELECT g.time, {", ".join(f"{e} AS {n}" for n, e in lead_c)} FROM grid g LEFT JOIN wide USING (time)),
lb AS (SELECT time, pos, load_mw, {_sel(lagc, False)} FROM series)
SELECT s.time AS prediction_time, {_r('s.load_mw', 'load_mw')}, {_sel([(n, 's.' + n) for n, _ in lagc])},
  {_sel([(n, 'cl.' + n) for n, _ in lead_c])}, {", ".join(f"{e} AS {n}" for n, e in cal)}
FROM lb s JOIN cl USING (time) WHERE s.pos >= 28 AND s.pos <= (SELECT max(pos) FROM series) - 7"""


SQL["feature_table_daily"] = _feature_table_daily()

SQL["sample_weight_mask"] = f"""WITH {panel_ctes()},
m AS (SELECT series_id, time, pos, max(CAST(was_null AS INTEGER)) OVER ({P}ORDER BY pos ROWS BETWEEN 168 PRECEDING AND 24 FOLLOWING) AS touch FROM series)
SELECT series_id, time AS prediction_time, CAST(CASE WHEN touch = 1 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS sample_weight
FROM m WHERE pos >= 168 AND pos <= (SELECT count(DISTINCT time) FROM grid) - 1 - 24"""

SQL["lag_safe_features"] = f"WITH {O.hourly_ctes()} SELECT time, {_sel(O.lag_block_sql(min_lag=3))} FROM series"

SQL["inject_missing_blocks"] = f"""WITH {panel_ctes()},
h AS (SELECT *, CAST('0x' || substr(md5(series_id || '|' || (pos // 24) || '|7'), 1, 8) AS BIGINT) % 1000 AS hv FROM series)
SELECT series_id, time, {_r('CASE WHEN hv < 100 THEN NULL ELSE load_mw END', 'load_mw')}, hv < 100 AS injected FROM h"""

TEST_LEN, CHUNK, HORIZON = 300, 5, 60


def _rolling_origin_cte() -> str:
    return f"""{panel_ctes()}, n AS (SELECT count(DISTINCT time) AS n FROM grid),
o AS (SELECT k.series_id, r.origin_pos FROM (SELECT DISTINCT series_id FROM series) k CROSS JOIN n
      CROSS JOIN LATERAL (SELECT unnest(generate_series(n.n - {TEST_LEN}, n.n - {CHUNK}, {CHUNK})) AS origin_pos) r),
rows AS (SELECT o.series_id, (o.origin_pos - (n.n - {TEST_LEN})) // {CHUNK} AS origin, h.h AS horizon,
           o.origin_pos + h.h - 1 AS pos, o.origin_pos + h.h - 1 - 24 * CAST(ceil(h.h / 24) AS BIGINT) AS src_pos
         FROM o CROSS JOIN n CROSS JOIN range(1, {HORIZON + 1}) h(h)),
ro AS (SELECT r.series_id, r.origin, r.horizon, r.pos, a.load_mw AS y, s.load_mw AS y_hat FROM rows r
       LEFT JOIN series a ON a.series_id = r.series_id AND a.pos = r.pos
       LEFT JOIN series s ON s.series_id = r.series_id AND s.pos = r.src_pos)"""


_ro_sel = f"series_id, CAST(origin AS BIGINT) AS origin, CAST(horizon AS BIGINT) AS horizon, CAST(pos AS BIGINT) AS pos, {_r('y')}, {_r('y_hat')}"
SQL["rolling_origin"] = f"WITH {_rolling_origin_cte()} SELECT {_ro_sel} FROM ro"
SQL["rolling_origin_mae"] = (f"WITH {_rolling_origin_cte()} SELECT CAST(horizon AS BIGINT) AS horizon, "
                             f"{_r('avg(abs(y - y_hat))', 'mae')} FROM ro WHERE y IS NOT NULL AND y_hat IS NOT NULL GROUP BY 1")
SQL["origin_overlay"] = (f"WITH {_rolling_origin_cte()} SELECT {_ro_sel} FROM ro, n "
                         f"WHERE origin < 12 AND pos < n.n - {TEST_LEN} + 90")


def _aicdf_edges(n_bins: int = 30) -> str:
    """Averaged inverted CDF edges from the sorted list (1-based)."""
    qs = ", ".join(repr(i / n_bins) for i in range(n_bins + 1))
    return f"""ys AS (SELECT list_sort(list(load_mw)) AS xs, count(load_mw) AS n FROM series WHERE load_mw IS NOT NULL),
qq AS (SELECT unnest([{qs}]) AS q),
ej AS (SELECT q, xs, n, n * q AS j FROM ys, qq),
ev AS (SELECT q, CASE WHEN abs(j - round(j)) < 1e-9 AND round(j) > 0 AND round(j) < n
                      THEN (xs[CAST(round(j) AS BIGINT)] + xs[CAST(round(j) AS BIGINT) + 1]) / 2
                      ELSE xs[CAST(least(greatest(ceil(j), 1), n) AS BIGINT)] END AS edge FROM ej),
ed AS (SELECT DISTINCT edge FROM ev),
edges AS (SELECT row_number() OVER (ORDER BY edge) - 1 AS edge_idx, edge FROM ed)"""


SQL["target_bins"] = f"WITH {O.hourly_ctes()}, {_aicdf_edges()} SELECT CAST(edge_idx AS BIGINT) AS edge_idx, {_r('edge')} FROM edges"

SQL["inverse_cdf"] = f"""WITH {O.hourly_ctes()}, {O.split_ctes()}, {_aicdf_edges()},
el AS (SELECT list(edge ORDER BY edge_idx) AS e, count(*) - 1 AS nb FROM edges),
tr AS (SELECT fb.fold_idx, s.load_mw FROM series s JOIN fb ON s.pos - 168 >= fb.train_start AND s.pos - 168 < fb.train_end),
hb AS (SELECT tr.fold_idx, least(greatest(len(list_filter(el.e, lambda v: v <= tr.load_mw)) - 1, 0), el.nb - 1) AS bin, count(*) AS c
       FROM tr CROSS JOIN el GROUP BY 1, 2),
cd AS (SELECT fold_idx, bin + 1 AS i, sum(c) OVER (PARTITION BY fold_idx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              / sum(c) OVER (PARTITION BY fold_idx) AS p FROM hb
       UNION ALL SELECT DISTINCT fold_idx, 0, 0.0 FROM hb),
sg AS (SELECT *, lag(p) OVER (PARTITION BY fold_idx ORDER BY i) AS p_prev FROM cd),
qs AS (SELECT unnest([0.05, 0.5, 0.95]) AS quantile),
hit AS (SELECT sg.*, qs.quantile, row_number() OVER (PARTITION BY fold_idx, quantile ORDER BY i) AS rn FROM sg, qs
        WHERE p_prev IS NOT NULL AND p >= quantile AND p_prev < quantile)
SELECT fold_idx, {_r('quantile')},
  {_r('el.e[i] + (el.e[i + 1] - el.e[i]) * (quantile - p_prev) / (p - p_prev)', 'value')}
FROM hit, el WHERE rn = 1"""

SQL["ridge_1d"] = f"""WITH {O.hourly_ctes()}, {O.split_ctes()},
lb AS (SELECT pos, load_mw AS y, lag(load_mw, 24) OVER (ORDER BY pos) AS x FROM series),
tr AS (SELECT fb.fold_idx, x, y FROM lb JOIN fb ON lb.pos - 168 >= fb.train_start AND lb.pos - 168 < fb.train_end),
g AS (SELECT fold_idx, covar_pop(x, y) AS cxy, var_pop(x) AS vx, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM tr GROUP BY 1)
SELECT fold_idx, {_r('cxy * n / (vx * n + 1.0)', 'slope')}, {_r('my - cxy * n / (vx * n + 1.0) * mx', 'intercept')} FROM g"""


# ------------------------------------------------------------ streaming twins
# A window is emitted once the final watermark (max event time − 3 h) passes its end.
_WM = "(SELECT max(ts) FROM events) - INTERVAL 3 HOUR"
_HOURLY_CLOSED = f"""SELECT date_trunc('hour', ts) AS time, round(sum(value), 6) AS load_mw, count(*) AS n_events
FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_WM}"""

SQL["stream_hourly_watermark"] = f"""WITH h AS ({_HOURLY_CLOSED})
SELECT time, {_r('load_mw')}, CAST(n_events AS BIGINT) AS n_events FROM h"""

SQL["stream_sliding_24h"] = f"""WITH e AS (SELECT value, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS ws FROM events, range(24) r(k))
SELECT ws AS window_start, ws + INTERVAL 24 HOUR AS window_end, CAST(count(*) AS BIGINT) AS n_events,
  {_r('avg(value)', 'mean_value')}, {_r('max(value)', 'max_value')}
FROM e GROUP BY ws HAVING ws + INTERVAL 24 HOUR <= {_WM}"""

SQL["stream_sliding_7d"] = f"""WITH e AS (SELECT value, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS ws FROM events, range(168) r(k))
SELECT ws AS window_start, ws + INTERVAL 168 HOUR AS window_end, CAST(count(*) AS BIGINT) AS n_events,
  {_r('avg(value)', 'mean_value')}, {_r('max(value)', 'max_value')}
FROM e GROUP BY ws HAVING ws + INTERVAL 168 HOUR <= {_WM}"""

for _name, _hours in (("24h", 24), ("7d", 168)):
    SQL[f"stream_quantiles_{_name}"] = f"""WITH e AS (SELECT value, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS we FROM events, range(-{_hours}, 0) r(k) WHERE value IS NOT NULL),
q AS (SELECT we, count(*) AS n, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75 FROM e GROUP BY we HAVING we <= {_WM})
SELECT we - INTERVAL {_hours} HOUR AS window_start, we AS window_end, CAST(n AS BIGINT) AS n_events, {_r('q25')}, {_r('q50', 'median_value')}, {_r('q75')}, {_r('q75 - q25', 'iqr')} FROM q"""

# every 7th event arrives a day late; a day's file is held against the days before it
SQL["stream_late_audit"] = """WITH e AS (SELECT ts, CAST(ts AS DATE) + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS arrival FROM events),
d AS (SELECT arrival, max(ts) AS m FROM e GROUP BY 1),
p AS (SELECT arrival, max(m) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3 HOUR AS mark FROM d)
SELECT CAST(floor((epoch_us(mark) - epoch_us(ts)) / 3600000000) AS BIGINT) AS hours_late, count(*) AS n_late
FROM e JOIN p USING (arrival) WHERE ts < mark GROUP BY 1"""

SQL["stream_lag_state"] = f"""WITH obs AS ({O.PANEL_OBS})
SELECT o.series_id, o.time, {_r('o.load_mw', 'load_mw')}, {_r('l1.load_mw', 'lag_1h')}, {_r('l24.load_mw', 'lag_24h')}
FROM obs o LEFT JOIN obs l1 ON l1.series_id = o.series_id AND l1.time = o.time - INTERVAL 1 HOUR
LEFT JOIN obs l24 ON l24.series_id = o.series_id AND l24.time = o.time - INTERVAL 24 HOUR"""

SQL["stream_calendar_join"] = f"""WITH h AS ({_HOURLY_CLOSED}), {O.holidays_sql('2023', '2025')}
SELECT time, {_r('load_mw')}, CAST(n_events AS BIGINT) AS n_events,
  {", ".join(f"{e} AS {n}" for n, e in O.calendar_cols_sql("time"))}
FROM h"""


_IC = ["load_mw_lag_1h", "load_mw_lag_2h", "load_mw_lag_3h", "load_mw_lag_1d"]
_IK = {"load_mw_lag_1h": 1, "load_mw_lag_2h": 2, "load_mw_lag_3h": 3, "load_mw_lag_1d": 24}
SQL["pairwise_interactions"] = (f"WITH {O.hourly_ctes()}, l AS (SELECT time, "
                                + ", ".join(f"lag(load_mw, {_IK[c]}) OVER (ORDER BY pos) AS {c}" for c in _IC)
                                + " FROM series) SELECT time, "
                                + _sel([(f"{a}_x_{b}", f"{a} * {b}") for i, a in enumerate(_IC) for b in _IC[i + 1:]])
                                + " FROM l")

# held until the final watermark (max time − 2 days) passes the row
SQL["stream_lag_state_ordered"] = SQL["stream_lag_state"] + (
    "\nWHERE o.time <= (SELECT max(time) FROM obs) - INTERVAL 2 DAY")

_TYPES = ["click", "error", "purchase", "signup", "view"]
SQL["explode_payload_arrays"] = f"""WITH h AS (SELECT date_trunc('hour', ts) AS time, round(sum(value), 6) AS load_mw,
  {', '.join(f"count(*) FILTER (WHERE event_type = '{e}') AS weather_n_events_{e}" for e in _TYPES)} FROM events GROUP BY 1),
g AS (SELECT DISTINCT date_trunc('day', time) AS day FROM h),
t AS (SELECT CAST(day AS TIMESTAMP) + k * INTERVAL 1 HOUR AS time FROM g, range(24) r(k))
SELECT t.time, {_r('load_mw')}, {', '.join(_r(f'weather_n_events_{e}') for e in _TYPES)} FROM t LEFT JOIN h USING (time)"""
