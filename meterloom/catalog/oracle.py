"""Independent SQL for the catalogue queries, over the same tables."""

from __future__ import annotations

from meterloom.functions import numeric

# Named building blocks; each may use those above it.
PARTS: dict[str, str] = {
    "readings": """
        SELECT event_type AS series_id, ts, event_id, user_id, value, props FROM events
        UNION ALL SELECT 'total', ts, event_id, user_id, value, props FROM events""",
    "load0": """
        SELECT series_id, time_bucket(INTERVAL 15 MINUTE, ts) AS ts,
               sum(value::DECIMAL(18,2))::DOUBLE AS load_kwh,
               sum(CASE WHEN value < 50 THEN value::DECIMAL(18,2) END)::DOUBLE AS base_customers,
               sum(CASE WHEN value >= 50 THEN value::DECIMAL(18,2) END)::DOUBLE AS free_customers
        FROM readings GROUP BY 1, 2""",
    "load": """
        SELECT *, timezone('Europe/Zurich', timezone('UTC', ts)) AS lt,
               year(lt) AS year, month(lt) AS month, day(lt) AS day, isodow(lt) - 1 AS weekday,
               dayofyear(lt) AS day_of_year, quarter(lt) AS quarter, weekofyear(lt) AS week
        FROM load0""",
    "shifted": """
        SELECT series_id, ts + INTERVAL 80 DAY AS ts, load_kwh,
               timezone('Europe/Zurich', timezone('UTC', ts + INTERVAL 80 DAY)) AS lt FROM load0""",
    "axis": """
        SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts
        FROM load0 GROUP BY series_id""",
    "pos": """
        SELECT series_id, ts, load_kwh, base_customers, free_customers,
               row_number() OVER s - 1 AS pos, count(*) OVER (PARTITION BY series_id) AS n_rows
        FROM load0 WINDOW s AS (PARTITION BY series_id ORDER BY ts)""",
    "weather_raw": """
        SELECT series_id, time_bucket(INTERVAL 10 MINUTE, ts) AS ts,
               CASE WHEN value >= 50 THEN 1 ELSE 0 END AS file_no, event_id AS row_no,
               value AS temp_2m, CASE WHEN value >= 20 THEN value * 2 END AS global_rad,
               user_id::DOUBLE AS wind_scalar_ms, props AS note
        FROM readings""",
    "weather": """
        SELECT series_id, ts, temp_2m, global_rad, wind_scalar_ms, note FROM weather_raw
        QUALIFY row_number() OVER (PARTITION BY series_id, ts
                                   ORDER BY file_no DESC, row_no DESC) = 1""",
    "on_axis": """
        SELECT a.series_id, a.ts, w.temp_2m, w.global_rad, w.wind_scalar_ms, w.note
        FROM axis a LEFT JOIN weather w USING (series_id, ts)""",
    "knots": """
        SELECT *,
          {knots}
        FROM on_axis
        WINDOW up AS (PARTITION BY series_id ORDER BY ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               down AS (PARTITION BY series_id ORDER BY ts
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "interpolated": """
        SELECT series_id, ts, {lines} FROM knots""",
    "nearest": """
        SELECT a.series_id, a.ts, w.note, w.temp_2m
        FROM {left} a LEFT JOIN weather w
          ON a.series_id = w.series_id AND w.ts BETWEEN a.ts - INTERVAL 450 SECOND AND a.ts + INTERVAL 450 SECOND
        QUALIFY row_number() OVER (PARTITION BY a.series_id, a.ts
            ORDER BY abs(epoch(w.ts) - epoch(a.ts)), w.ts) = 1""",
    "lagged": """
        SELECT series_id, ts, load_kwh, pos, n_rows,
               lag(load_kwh, 1) OVER s AS lag_15m, lag(load_kwh, 2) OVER s AS lag_30m,
               lag(load_kwh, 4) OVER s AS lag_1h, lag(load_kwh, 96) OVER s AS lag_24h,
               lag(base_customers) OVER s AS base_customers_lag_15m,
               lag(free_customers) OVER s AS free_customers_lag_15m
        FROM pos WINDOW s AS (PARTITION BY series_id ORDER BY ts)""",
    "naive": """
        SELECT series_id, ts, load_kwh AS y, lag_24h AS yhat, lag_15m AS yhat_1,
               CASE WHEN pos < floor(n_rows * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split
        FROM lagged WHERE pos >= 96""",
    "hourly": """
        SELECT series_id, date_trunc('hour', ts) AS ts, avg(load_kwh) AS load_kwh
        FROM load0 GROUP BY 1, 2""",
    "origins": """
        SELECT series_id, ts AS origin, load_kwh AS yhat FROM load
        WHERE hour(lt) = 0 AND minute(lt) = 0""",
    "blocks": """
        SELECT o.series_id, o.origin, l.load_kwh AS y, o.yhat
        FROM (SELECT *, unnest(generate_series(origin, origin + INTERVAL 1425 MINUTE,
                                               INTERVAL 15 MINUTE)) AS ts FROM origins) o
        LEFT JOIN load l USING (series_id, ts)""",
}

NUMBERS = ("temp_2m", "global_rad", "wind_scalar_ms")
PARTS["knots"] = PARTS["knots"].format(
    knots=",\n          ".join(
        f"last_value(CASE WHEN {c} IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER up AS {c}_t0, "
        f"last_value({c} IGNORE NULLS) OVER up AS {c}_v0, "
        f"first_value(CASE WHEN {c} IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER down AS {c}_t1, "
        f"first_value({c} IGNORE NULLS) OVER down AS {c}_v1"
        for c in NUMBERS
    )
)
PARTS["interpolated"] = PARTS["interpolated"].format(
    lines=", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_t0 IS NULL THEN {c}_v1 "
        f"WHEN {c}_t1 IS NULL THEN {c}_v0 "
        f"ELSE {c}_v0 + ({c}_v1 - {c}_v0) / ({c}_t1 - {c}_t0) * (epoch(ts) - {c}_t0) END AS {c}"
        for c in NUMBERS
    )
)
PARTS["nearest_load"] = PARTS["nearest"].format(left="load0")
PARTS["nearest_axis"] = PARTS.pop("nearest").format(left="axis")
PARTS["text_filled"] = """
        SELECT series_id, ts, coalesce(last_value(note IGNORE NULLS) OVER up,
                                       first_value(note IGNORE NULLS) OVER down) AS note
        FROM nearest_axis
        WINDOW up AS (PARTITION BY series_id ORDER BY ts
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               down AS (PARTITION BY series_id ORDER BY ts
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""
PARTS["after_drop"] = """
        SELECT g.series_id, g.ts, g.load_kwh, g.lag_15m, g.lag_30m, g.lag_1h, g.lag_24h,
               g.base_customers_lag_15m, g.free_customers_lag_15m,
               g.lag_15m - g.lag_30m AS diff_15m,
               l.month, l.day, l.weekday, l.day_of_year, l.quarter, l.week, l.lt, t.note,
               i.temp_2m, i.global_rad, i.wind_scalar_ms
        FROM lagged g JOIN load l USING (series_id, ts)
        JOIN interpolated i USING (series_id, ts) JOIN text_filled t USING (series_id, ts)
        WHERE g.pos >= 96"""
PARTS["features"] = """
        SELECT series_id, ts, load_kwh, month, day, weekday, day_of_year, quarter, week, note,
               lag_15m, lag_30m, lag_1h, lag_24h, base_customers_lag_15m, free_customers_lag_15m,
               lag(global_rad) OVER s AS global_rad_lag15, lag(temp_2m) OVER s AS temp_2m_lag15,
               lag(wind_scalar_ms) OVER s AS wind_scalar_ms_lag15, diff_15m,
               strftime(lt, '%Y-%m-%d') AS local_date, strftime(lt, '%H:%M:%S') AS local_time,
               hour(lt) AS local_hour, (weekday = 6)::INT AS is_sunday,
               (weekday < 5)::INT AS is_workday
        FROM after_drop WINDOW s AS (PARTITION BY series_id ORDER BY ts)"""

NEEDS = {
    "load0": ["readings"],
    "load": ["load0"],
    "shifted": ["load0"],
    "axis": ["load0"],
    "pos": ["load0"],
    "weather_raw": ["readings"],
    "weather": ["weather_raw"],
    "on_axis": ["axis", "weather"],
    "knots": ["on_axis"],
    "interpolated": ["knots"],
    "nearest_load": ["load0", "weather"],
    "nearest_axis": ["axis", "weather"],
    "text_filled": ["nearest_axis"],
    "lagged": ["pos"],
    "naive": ["lagged"],
    "hourly": ["load0"],
    "origins": ["load"],
    "blocks": ["origins", "load"],
    "after_drop": ["lagged", "load", "interpolated", "text_filled"],
    "features": ["after_drop"],
}

SQL: dict[str, str] = {}


def with_parts(body: str, *parts: str, recursive: bool = False, **extra: str) -> str:
    """Statement with the named parts, and what they need, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for part in parts:
        add(part)
    kind = "AS MATERIALIZED" if recursive else "AS"
    ctes = [f"{p} {kind} ({PARTS[p]})" for p in order] + [f"{n} AS ({b})" for n, b in extra.items()]
    word = "WITH RECURSIVE" if recursive else "WITH"
    return (f"{word} " + ",\n".join(ctes) + "\n" if ctes else "") + body


def define(name: str, body: str, *parts: str, recursive: bool = False, **extra: str) -> None:
    SQL[name] = with_parts(body, *parts, recursive=recursive, **extra)


# Moves values off exact ties of the sixth digit, which engines round differently.
OFF_TIE = "1.2345e-8"


def r6(expr: str, name: str | None = None) -> str:
    return f"round(({expr}) + {OFF_TIE}, 6) + 0.0 AS {name or expr}"


def r6s(*names: str) -> str:
    return ", ".join(r6(n) for n in names)


BOX = """
    SELECT {key} count(*) AS n_values, {q1}, {q2}, {q3},
           {low}, {high},
           count(CASE WHEN v < q1 - (q3 - q1) * 1.5 OR v > q3 + (q3 - q1) * 1.5 THEN 1 END) AS n_outliers
    FROM boxed {group}"""


def box(key: str | None, source: str) -> tuple[str, str]:
    """Body and ``boxed`` part of a box query over ``source(v[, key])``."""
    k = f"{key}, " if key else ""
    over = f"PARTITION BY {key}" if key else ""
    boxed = f"""
        SELECT {k} v, quantile_cont(v, 0.25) OVER ({over}) AS q1, quantile_cont(v, 0.5) OVER ({over}) AS q2,
               quantile_cont(v, 0.75) OVER ({over}) AS q3 FROM ({source}) WHERE v IS NOT NULL"""
    body = BOX.format(
        key=k,
        q1=r6("any_value(q1)", "q1"),
        q2=r6("any_value(q2)", "median"),
        q3=r6("any_value(q3)", "q3"),
        low=r6("least(min(CASE WHEN v >= q1 - (q3 - q1) * 1.5 THEN v END), any_value(q1))", "whisker_low"),
        high=r6("greatest(max(CASE WHEN v <= q3 + (q3 - q1) * 1.5 THEN v END), any_value(q3))", "whisker_high"),
        group=f"GROUP BY {key}" if key else "",
    )
    return body, boxed


def r2_rule(y: str, yhat: str, f: str = "") -> str:
    """R² of at least two values; constant actuals score 1 without error, else 0."""
    left_over = f"sum(({y} - {yhat}) ^ 2){f}"
    return f"""CASE WHEN count({y}){f} < 2 THEN NULL
        WHEN var_pop({y}){f} = 0 THEN CASE WHEN {left_over} = 0 THEN 1.0 ELSE 0.0 END
        ELSE 1 - {left_over} / (var_pop({y}){f} * count({y}){f}) END"""


def metric_columns(y: str = "y", yhat: str = "yhat", suffix: str = "", where: str = "") -> str:
    """Rounded error aggregates; ``where`` restricts the rows of each."""
    f = f" FILTER (WHERE {where})" if where else ""
    return ", ".join(
        [
            r6(f"avg(abs({y} - {yhat})){f}", f"mae{suffix}"),
            r6(f"sqrt(avg(({y} - {yhat}) ^ 2){f})", f"rmse{suffix}"),
            r6(r2_rule(y, yhat, f), f"r2{suffix}"),
            r6(f"avg(abs(({y} - {yhat}) / CASE WHEN {y} = 0 THEN 1e-6 ELSE {y} END)){f} * 100", f"mape{suffix}"),
        ]
    )


# --- axis, regridding, gaps ---------------------------------------------------------------

define("load_15min_regrid",
       "SELECT series_id, ts, load_kwh, base_customers, free_customers FROM axis LEFT JOIN load0 USING (series_id, ts)",
       "axis")
define("gap_report", """
    SELECT series_id, ((epoch(max(ts)) - epoch(min(ts))) / 900)::BIGINT + 1 AS expected, count(*) AS present,
           0::BIGINT AS surplus_rows, ((epoch(max(ts)) - epoch(min(ts))) / 900)::BIGINT + 1 - count(*) AS missing
    FROM load0 GROUP BY series_id""", "load0")
define("missing_slots", "SELECT series_id, ts FROM axis ANTI JOIN load0 USING (series_id, ts)", "axis")
define("duplicate_keys",
       "SELECT series_id, ts, count(*) AS n_rows FROM weather_raw GROUP BY ALL HAVING count(*) > 1", "weather_raw")

# --- positions, lags, leads ---------------------------------------------------------------

define("row_position", "SELECT series_id, ts, pos, n_rows FROM pos", "pos")
define("load_lag_features", f"""
    SELECT series_id, ts, {r6s('load_kwh', 'lag_15m', 'lag_30m', 'lag_1h', 'lag_24h',
                               'base_customers_lag_15m', 'free_customers_lag_15m')},
           {r6('lag_15m - lag_30m', 'diff_15m')}
    FROM lagged WHERE pos >= 96""", "lagged")
define("week_lag", """
    SELECT series_id, ts, load_kwh, lag(load_kwh, 672) OVER (PARTITION BY series_id ORDER BY ts) AS lag_week
    FROM load0""", "load0")
define("rolling_means", "SELECT series_id, ts, " + r6("load_kwh") + ", " + ", ".join(
    r6(f"avg(load_kwh) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)", n)
    for n, k in (("mean_3h", 12), ("mean_12h", 48), ("mean_24h", 96))) + " FROM load0", "load0")
define("multi_horizon_targets", f"""
    SELECT series_id, ts, lead(load_kwh, 1) OVER s AS t_1, lead(load_kwh, 48) OVER s AS t_48,
           lead(load_kwh, 96) OVER s AS t_96,
           {r6('sum(load_kwh) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 96 FOLLOWING)', 't_sum')}
    FROM pos WINDOW s AS (PARTITION BY series_id ORDER BY ts) QUALIFY lead(load_kwh, 96) OVER s IS NOT NULL""", "pos")
define("horizon_long_form", f"""
    SELECT a.series_id, h, count(*) AS n_rows, {r6('avg(b.load_kwh)', 'mean_y')}
    FROM pos a CROSS JOIN range(1, 97) t(h) JOIN pos b ON a.series_id = b.series_id AND b.pos = a.pos + h
    WHERE a.pos + 96 < a.n_rows GROUP BY a.series_id, h""", "pos")
define("every_fourth_row", "SELECT series_id, ts, load_kwh FROM pos WHERE pos % 4 = 0", "pos")
define("half_hour_rows", "SELECT series_id, ts, load_kwh FROM pos WHERE pos % 2 = 0", "pos")

# --- calendar -----------------------------------------------------------------------------

define("calendar_local", """
    SELECT series_id, ts, year(lt) AS year, month(lt) AS month, day(lt) AS day, isodow(lt) - 1 AS weekday,
           dayofyear(lt) AS day_of_year, quarter(lt) AS quarter, weekofyear(lt) AS week,
           strftime(lt, '%Y-%m-%d') AS local_date, strftime(lt, '%H:%M:%S') AS local_time, hour(lt) AS local_hour,
           (isodow(lt) = 7)::INT AS is_sunday, (isodow(lt) < 6)::INT AS is_workday, dayname(ts) AS day_name,
           ['Jan', 'Feb', 'Mär', 'Apr', 'Mai', 'Jun', 'Jul', 'Aug', 'Sep', 'Okt', 'Nov', 'Dez'][month(lt)] AS month_name,
           CASE WHEN month(lt) IN (12, 1, 2) THEN 1 WHEN month(lt) <= 5 THEN 2 WHEN month(lt) <= 8 THEN 3 ELSE 4 END AS season
    FROM shifted""", "shifted")
define("cyclic_encoding", "SELECT series_id, ts, " + ", ".join(
    r6(f"{f}(2 * pi() * {base} / {p})", f"{n}_{f}")
    for n, base, p in (("month", "month(lt)", 12), ("weekday", "(isodow(lt) - 1)", 7),
                       ("hour", "hour(lt)", 24), ("day_of_year", "dayofyear(lt)", 365))
    for f in ("sin", "cos")) + " FROM shifted", "shifted")
define("dst_local_day_counts", """
    SELECT series_id, strftime(lt, '%Y-%m-%d') AS local_date, count(*) AS n_slots,
           count(CASE WHEN hour(lt) = 2 THEN 1 END) AS n_slots_hour_2
    FROM (SELECT series_id, timezone('Europe/Zurich', timezone('UTC', unnest(
              generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)))) AS lt FROM shifted GROUP BY series_id)
    GROUP BY ALL""", "shifted")
define("zone_round_trip", """
    SELECT o_orderkey, timezone('Europe/Zurich', timezone('UTC', o_orderdate + INTERVAL 12 HOUR)) AS local_ts,
           o_orderdate + INTERVAL 12 HOUR AS utc_ts FROM orders""")
define("holiday_flags", """
    SELECT strftime(ds, '%Y-%m-%d') AS ds, n_orders, (strftime(ds, '%m-%d') = '01-01')::INT AS new_year,
           (strftime(ds, '%m-%d') = '08-01')::INT AS national_day, (strftime(ds, '%m-%d') = '12-25')::INT AS christmas,
           (ds IN (SELECT d FROM ascension))::INT AS ascension,
           (strftime(ds, '%m-%d') IN ('01-01', '08-01', '12-25') OR ds IN (SELECT d FROM ascension))::INT AS is_holiday
    FROM (SELECT o_orderdate::DATE AS ds, count(*) AS n_orders FROM orders GROUP BY 1)""",
       ascension="""SELECT unnest([DATE '1995-05-25', DATE '1996-05-16', DATE '1997-05-08', DATE '1998-05-21',
                                   DATE '1999-05-13', DATE '2000-06-01', DATE '2001-05-24']) AS d""")

# --- weather ------------------------------------------------------------------------------

define("weather_keep_last", "SELECT * FROM weather", "weather")
define("weather_interpolate_15min", f"SELECT series_id, ts, {r6s(*NUMBERS)} FROM interpolated", "interpolated")
define("weather_asof_nearest", "SELECT series_id, ts, note, temp_2m FROM nearest_load", "nearest_load")
define("weather_text_on_axis", "SELECT series_id, ts, note FROM nearest_axis", "nearest_axis")
define("ffill_then_bfill", """
    SELECT series_id, ts, coalesce(global_rad_v0, global_rad_v1) AS global_rad,
           coalesce(last_value(note IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    first_value(note IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS note
    FROM knots""", "knots")
define("weather_asof_backward", """
    SELECT l.series_id, l.ts, l.load_kwh, w.temp_2m, w.note
    FROM load0 l ASOF LEFT JOIN weather w ON l.series_id = w.series_id AND l.ts >= w.ts""", "load0", "weather")
define("merged_features", f"""
    SELECT series_id, ts, {r6('load_kwh')}, month, day, weekday, day_of_year, quarter, week, note,
           {r6s('lag_15m', 'lag_30m', 'lag_1h', 'lag_24h', 'base_customers_lag_15m', 'free_customers_lag_15m',
                'global_rad_lag15', 'temp_2m_lag15', 'wind_scalar_ms_lag15', 'diff_15m')},
           local_date, local_time, local_hour, is_sunday, is_workday FROM features""", "features")

# --- resampling and profiles --------------------------------------------------------------

define("hourly_mean", f"SELECT series_id, ts, {r6('load_kwh')} FROM hourly", "hourly")
# The stream has closed the hours that end two hours or more before the last stamp of any series.
define("streamed_hourly_mean", f"""
    SELECT series_id, ts, {r6('load_kwh')} FROM hourly
    WHERE ts + INTERVAL 3 HOUR <= (SELECT max(ts) FROM load0)""", "hourly", "load0")
define("streamed_daily_totals", f"""
    SELECT series_id, strftime(lt, '%Y-%m-%d') AS ds, {r6('sum(load_kwh)', 'y')}, count(load_kwh) AS n_slots
    FROM shifted WHERE date_trunc('hour', ts) + INTERVAL 3 HOUR <= (SELECT max(ts) FROM shifted) GROUP BY 1, 2""", "shifted")
define("daily_totals", f"""
    SELECT series_id, strftime(lt, '%Y-%m-%d') AS ds, {r6('sum(load_kwh)', 'y')}, count(load_kwh) AS n_slots
    FROM shifted GROUP BY 1, 2""", "shifted")
define("daily_complete_days", f"""
    SELECT series_id, strftime(lt, '%Y-%m-%d') AS ds, {r6('avg(load_kwh)', 'y')}, count(load_kwh) AS n_slots
    FROM shifted GROUP BY 1, 2 HAVING count(load_kwh) = 96""", "shifted")
define("hour_weekday_pivot", "SELECT series_id, hour(ts) AS hour, " + ", ".join(
    r6(f"avg(load_kwh) FILTER (WHERE isodow(ts) = {i + 1})", d)
    for i, d in enumerate(("Mo", "Di", "Mi", "Do", "Fr", "Sa", "So"))) + " FROM load0 GROUP BY 1, 2", "load0")
define("daily_profile", f"SELECT series_id, hour(ts) AS hour, {r6('avg(load_kwh)', 'mean')} FROM load0 GROUP BY 1, 2",
       "load0")
_body, _boxed = box("day_name", "SELECT dayname(ts) AS day_name, load_kwh AS v FROM load0")
define("box_by_weekday", _body, "load0", boxed=_boxed)
_body, _boxed = box("month_name", """SELECT ['Jan', 'Feb', 'Mär', 'Apr', 'Mai', 'Jun', 'Jul', 'Aug', 'Sep', 'Okt',
    'Nov', 'Dez'][month(o_orderdate)] AS month_name, o_totalprice AS v FROM orders""")
define("box_by_month", _body, boxed=_boxed)
_body, _boxed = box(None, "SELECT value AS v FROM events")
define("box_global", _body, boxed=_boxed)
define("outlier_rows", """
    SELECT event_id, event_type, value FROM (
        SELECT *, quantile_cont(value, 0.25) OVER t AS q1, quantile_cont(value, 0.75) OVER t AS q3
        FROM events WINDOW t AS (PARTITION BY event_type))
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
define("histogram_100", f"""
    SELECT series_id, bin, {r6('lo + bin * ((hi - lo) / 100)', 'low')},
           {r6('CASE WHEN bin = 99 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 100) END', 'high')}, coalesce(n, 0) AS n_values
    FROM (SELECT *, unnest(range(100)) AS bin FROM bounds) b LEFT JOIN (
        SELECT series_id, CASE WHEN load_kwh < lo + g * ((hi - lo) / 100) THEN g - 1
                               WHEN g < 99 AND load_kwh >= lo + (g + 1) * ((hi - lo) / 100) THEN g + 1 ELSE g END AS bin,
               count(*) AS n
        FROM (SELECT *, least(floor((load_kwh - lo) / (hi - lo) * 100), 99) AS g FROM load0 JOIN bounds USING (series_id))
        GROUP BY 1, 2) c USING (series_id, bin)""", "load0",
       bounds="SELECT series_id, min(load_kwh) AS lo, max(load_kwh) AS hi FROM load0 GROUP BY 1")
define("histogram_centre", f"""
    SELECT series_id, {r6('avg(load_kwh)', 'mean')}, {r6('quantile_cont(load_kwh, 0.5)', 'median')} FROM load0 GROUP BY 1""", "load0")
define("describe_columns", f"""
    SELECT series_id, "column", count(value) AS n_values, count(*) - count(value) AS n_null, {r6('avg(value)', 'mean')},
           {r6('stddev_samp(value)', 'std')}, min(value) AS min, max(value) AS max,
           {r6('quantile_cont(value, 0.25)', 'q1')}, {r6('quantile_cont(value, 0.5)', 'median')},
           {r6('quantile_cont(value, 0.75)', 'q3')}
    FROM (SELECT series_id, 'load_kwh' AS "column", load_kwh AS value FROM load0
          UNION ALL SELECT series_id, 'base_customers', base_customers FROM load0
          UNION ALL SELECT series_id, 'free_customers', free_customers FROM load0) GROUP BY 1, 2""", "load0")


def _horner(x: str, coefficients: tuple[float, ...]) -> str:
    text = repr(coefficients[-1]) + "::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _ratio(x: str, top: tuple[float, ...], bottom: tuple[float, ...]) -> str:
    return f"{_horner(x, top)} / {_horner(x, bottom)}"


QQ = {
    "ranked": """SELECT series_id, load_kwh, row_number() OVER (PARTITION BY series_id ORDER BY load_kwh) AS i,
                        count(*) OVER (PARTITION BY series_id) AS n FROM load0""",
    "medians": """SELECT *, CASE WHEN i = n THEN 0.5::DOUBLE ^ (1.0::DOUBLE / n)
                                 WHEN i = 1 THEN 1 - 0.5::DOUBLE ^ (1.0::DOUBLE / n)
                                 ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM ranked""",
    "tails": """SELECT *, p - 0.5 AS q, 0.180625 - (p - 0.5) * (p - 0.5) AS c,
                       sqrt(-ln(CASE WHEN p < 0.5 THEN p ELSE 1 - p END)) AS r FROM medians""",
    "points": f"""SELECT series_id, i - 1 AS rank, load_kwh, CASE WHEN abs(q) <= 0.425
        THEN q * {_ratio('c', numeric._CENTRE_TOP, numeric._CENTRE_BOTTOM)}
        ELSE sign(q) * CASE WHEN r <= 5 THEN {_ratio('(r - 1.6)', numeric._NEAR_TOP, numeric._NEAR_BOTTOM)}
                            ELSE {_ratio('(r - 5.0)', numeric._FAR_TOP, numeric._FAR_BOTTOM)} END END AS theoretical
        FROM tails""",
}
define("normal_qq", f"SELECT series_id, rank, {r6s('theoretical', 'load_kwh')} FROM points", "load0", **QQ)
define("normal_qq_line", f"""
    SELECT series_id, {r6('regr_slope(load_kwh, theoretical)', 'slope')},
           {r6('regr_intercept(load_kwh, theoretical)', 'intercept')}, {r6('corr(load_kwh, theoretical)', 'r')}
    FROM points GROUP BY 1""", "load0", **QQ)

# --- correlation --------------------------------------------------------------------------

CORRELATED = (
    "load_kwh", "lag_15m", "lag_30m", "lag_1h", "lag_24h", "base_customers_lag_15m",
    "free_customers_lag_15m", "diff_15m", "temp_2m_lag15", "global_rad_lag15",
    "wind_scalar_ms_lag15", "local_hour", "is_sunday", "is_workday", "day",
)
define("corr_with_target_top20", "\n    UNION ALL ".join(
    f"SELECT series_id, '{c}' AS feature, " + r6(f"abs(corr({c}, load_kwh))", "abs_r") + " FROM features GROUP BY 1"
    for c in CORRELATED), "features")
define("corr_matrix", "\n    UNION ALL ".join(
    f"SELECT series_id, '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})', 'r')} FROM features GROUP BY 1"
    for i, a in enumerate(CORRELATED[:9]) for b in CORRELATED[i + 1:9]), "features")
define("corr_top5", "SELECT * FROM (" + "\n    UNION ALL ".join(
    f"SELECT series_id, '{c}' AS feature, " + r6(f"abs(corr({c}, load_kwh))", "abs_r") + " FROM features GROUP BY 1"
    for c in CORRELATED)
    + ") QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY abs_r DESC NULLS LAST, feature) <= 5", "features")
define("corr_matrix_of_top6", "SELECT series_id, CASE WHEN x.place < y.place THEN a ELSE b END AS a, "
       "CASE WHEN x.place < y.place THEN b ELSE a END AS b, r FROM (" + "\n    UNION ALL ".join(
    f"SELECT series_id, '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})', 'r')} FROM features GROUP BY 1"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:])
    + ") JOIN top6 x ON x.feature = a JOIN top6 y ON y.feature = b", "features",
    top6="SELECT feature, row_number() OVER (ORDER BY abs_r DESC NULLS LAST, feature) AS place FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, abs(corr({c}, load_kwh)) AS abs_r FROM features" for c in CORRELATED)
    + ") QUALIFY place <= 6")
define("linfit_lag1", f"""
    SELECT series_id, {r6('regr_slope(load_kwh, lag_15m)', 'slope')}, {r6('regr_intercept(load_kwh, lag_15m)', 'intercept')}
    FROM lagged GROUP BY 1""", "lagged")
define("acf_168", f"""
    SELECT series_id, lag, {r6('acf')},
           {r6('''CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
                 OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END''', 'band')}
    FROM (SELECT a.series_id, lag, any_value(a.n) AS n, sum(a.x * b.x) / any_value(a.c0) AS acf
          FROM thin a CROSS JOIN range(0, 169) t(lag) JOIN thin b ON a.series_id = b.series_id AND b.i = a.i + lag
          GROUP BY 1, 2)""", "pos",
       thin0="""SELECT series_id, pos // 4 AS i, load_kwh - avg(load_kwh) OVER (PARTITION BY series_id) AS x,
                       count(*) OVER (PARTITION BY series_id) AS n FROM pos WHERE pos % 4 = 0""",
       thin="SELECT *, sum(x * x) OVER (PARTITION BY series_id) AS c0 FROM thin0")


def decomposition(rows: str, y: str, period: int, *parts: str, **extra: str) -> str:
    half = period // 2
    if period % 2 == 0:
        mean = f"""(avg({y}) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half - 1} FOLLOWING)
                 + avg({y}) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half - 1} PRECEDING AND {half} FOLLOWING)) / 2"""
    else:
        mean = f"avg({y}) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    return with_parts(
        f"""SELECT series_id, ts, {r6(y)}, {r6('trend')}, {r6('seasonal')}, {r6(f'{y} - trend - seasonal', 'resid')}
            FROM trends JOIN seasons USING (series_id, phase)""",
        *parts,
        **extra,
        numbered=f"""SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS i,
                            count(*) OVER (PARTITION BY series_id) AS n FROM {rows}""",
        trends=f"""SELECT series_id, ts, {y}, i % {period} AS phase,
                          CASE WHEN i >= {half} AND i < n - {half} THEN {mean} END AS trend
                   FROM numbered WHERE n >= {2 * period}""",
        phases=f"SELECT series_id, phase, avg({y} - trend) AS m FROM trends GROUP BY 1, 2",
        seasons="SELECT series_id, phase, m - avg(m) OVER (PARTITION BY series_id) AS seasonal FROM phases",
    )


SQL["seasonal_decompose"] = decomposition("hourly", "load_kwh", 168, "hourly")
SQL["seasonal_decompose_daily"] = decomposition(
    "days", "y", 7,
    days="""SELECT o_orderpriority AS series_id, o_orderdate AS ts, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / 1000 AS y
            FROM orders GROUP BY 1, 2""")

# --- splits and samples -------------------------------------------------------------------

DRAW = "md5('42|' || series_id || '|' || epoch(ts)::BIGINT)"
define("time_split", """SELECT series_id, ts, CASE WHEN pos < floor(n_rows * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split
                        FROM pos""", "pos")
define("tail_sample", "SELECT series_id, ts, load_kwh FROM pos WHERE pos >= n_rows - 500", "pos")
define("seeded_sample", f"SELECT series_id, ts, load_kwh FROM load0 ORDER BY {DRAW}, series_id, ts LIMIT 8000", "load0")
define("seeded_origins", f"""SELECT series_id, ts FROM load WHERE hour(lt) = 0 AND minute(lt) = 0
                             ORDER BY {DRAW}, series_id, ts LIMIT 40""", "load")
define("column_shuffle", """
    SELECT a.series_id, a.ts, b.load_kwh, a.base_customers FROM pos a JOIN donors b
      ON a.series_id = b.series_id AND a.pos = b.i""", "pos",
       donors=f"SELECT series_id, load_kwh, row_number() OVER (PARTITION BY series_id ORDER BY {DRAW}) - 1 AS i FROM pos")
define("day_slice", """SELECT series_id, ts, load_kwh FROM load0
                       WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'""", "load0")
define("semi_join_keys", "SELECT series_id, ts, load_kwh FROM load0 SEMI JOIN weather_raw USING (series_id, ts)",
       "load0", "weather_raw")

# --- metrics ------------------------------------------------------------------------------

define("metrics_naive96", f"SELECT series_id, count(*) AS n_rows, {metric_columns()} FROM naive GROUP BY 1", "naive")
define("metrics_train_test", f"""
    SELECT series_id, {metric_columns(suffix='_train', where="split = 'train'")},
           {metric_columns(suffix='_test', where="split = 'test'")} FROM naive GROUP BY 1""", "naive")
define("score_bias_and_floor_mape", f"""
    SELECT series_id, {r6('avg(yhat - y)', 'bias')}, {r6('avg(abs((y - yhat) / greatest(y, 1e-6))) * 100', 'mape_floor')}
    FROM naive GROUP BY 1""", "naive")
define("example_day_metrics", f"""
    SELECT series_id, count(*) AS n_rows, {metric_columns()} FROM naive
    WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1""", "naive")
define("best_model_by_rmse", f"""
    SELECT series_id, model, {r6('rmse', 'rmse_test')} FROM (
        SELECT series_id, 'day_before' AS model, sqrt(avg((y - yhat) ^ 2)) AS rmse FROM naive WHERE split = 'test' GROUP BY 1
        UNION ALL
        SELECT series_id, 'slot_before', sqrt(avg((y - yhat_1) ^ 2)) FROM naive WHERE split = 'test' GROUP BY 1)
    QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY rmse, model) = 1""", "naive")
BLOCK_METRICS = metric_columns()
BLOCK_ERRORS = f"""avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) ^ 2)) AS rmse, {r2_rule('y', 'yhat')} AS r2,
    avg(abs((y - yhat) / CASE WHEN y = 0 THEN 1e-6 ELSE y END)) * 100 AS mape"""


def block_query(max_missing: int, columns: str = BLOCK_METRICS) -> str:
    return f"""SELECT series_id, origin, count(y) AS n_used, {columns} FROM blocks GROUP BY 1, 2
               HAVING count(y) >= 10 AND count(*) - count(y) <= {max_missing}"""


define("block_metrics_midnight", block_query(4), "blocks")
define("block_metrics_summary", f"""
    SELECT series_id, count(*) AS n_blocks, {', '.join(r6(f'avg({m})', f'{m}_mean') for m in ('mae', 'rmse', 'r2', 'mape'))},
           {r6('quantile_cont(mae, 0.5)', 'mae_median')} FROM scored GROUP BY 1""", "blocks", scored=block_query(4, BLOCK_ERRORS))
define("block_rmse_score", f"SELECT {r6('avg(rmse)', 'score')} FROM scored", "blocks", scored=block_query(4, BLOCK_ERRORS))

# --- modelling frame ----------------------------------------------------------------------

define("modelling_rows", f"""
    SELECT series_id, ts, {r6('load_kwh')}, {', '.join(r6(f'{f}(2 * pi() * {base} / {p})', f'{n}_{f}')
        for n, base, p in (('month', 'month', 12), ('weekday', 'weekday', 7), ('hour', 'local_hour', 24),
                           ('day_of_year', 'day_of_year', 365)) for f in ('sin', 'cos'))},
           week, is_workday, is_sunday, {r6s('lag_1h', 'lag_24h', 'global_rad_lag15', 'temp_2m_lag15', 'wind_scalar_ms_lag15')},
           pos, n_rows, CASE WHEN pos < floor(n_rows * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS pos,
                 count(*) OVER (PARTITION BY series_id) AS n_rows
          FROM features WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-30 12:00:00')""", "features")

# --- flags --------------------------------------------------------------------------------

define("extreme_weather_flag", """
    SELECT series_id, ts, temp_2m, (temp_2m < quantile_cont(temp_2m, 0.05) OVER s
                                    OR temp_2m > quantile_cont(temp_2m, 0.95) OVER s)::INT AS is_extreme
    FROM weather WINDOW s AS (PARTITION BY series_id)""", "weather")
define("anomaly_flags", f"""
    SELECT series_id, ts, {r6s('y', 'yhat', 'z')}, (abs(z) > 2.5)::INT AS is_anomaly
    FROM (SELECT *, (y - yhat - avg(y - yhat) OVER s) / stddev_pop(y - yhat) OVER s AS z FROM naive
          WINDOW s AS (PARTITION BY series_id))""", "naive")

# --- files --------------------------------------------------------------------------------

define("load_csv_round_trip", "SELECT * EXCLUDE (lt) FROM load", "load")
define("weather_csv_round_trip", "SELECT series_id, ts, temp_2m, global_rad, wind_scalar_ms, note FROM weather", "weather")
SQL["report_round_trip"] = SQL["metrics_naive96"]
define("features_csv_round_trip", f"""
    SELECT series_id, ts, {r6('load_kwh')}, month, day, weekday, day_of_year, quarter, week,
           {r6s('lag_15m', 'lag_30m', 'lag_1h', 'lag_24h', 'base_customers_lag_15m', 'free_customers_lag_15m',
                'global_rad_lag15', 'temp_2m_lag15', 'wind_scalar_ms_lag15', 'diff_15m')},
           local_date, local_time, local_hour, is_sunday, is_workday FROM features""", "features")
define("features_parquet_round_trip", """
    SELECT series_id, split, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
    FROM (SELECT series_id, ts, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1
                                          < floor(count(*) OVER (PARTITION BY series_id) * 0.7::DOUBLE)
                                     THEN 'train' ELSE 'test' END AS split
          FROM lagged WHERE pos >= 96)
    GROUP BY 1, 2""", "lagged")

# --- forecasts ----------------------------------------------------------------------------

PARTS["model_frame"] = """
        SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS p FROM features"""
NEEDS["model_frame"] = ["features"]
PARTS["starts"] = """
        SELECT o.series_id, o.ts AS origin, max(r.ts) + INTERVAL 15 MINUTE AS start, list(r.load_kwh ORDER BY r.p) AS hist,
               last(r.base_customers_lag_15m ORDER BY r.p) AS base_last
        FROM model_frame o JOIN model_frame r ON r.series_id = o.series_id AND r.p BETWEEN o.p - 96 AND o.p - 1
        WHERE o.p >= 96 AND right(o.local_time, 5) = '00:00' AND o.local_hour = 0
        GROUP BY 1, 2 HAVING min(r.ts) >= o.ts - INTERVAL 15 MINUTE - INTERVAL 7 DAY"""
NEEDS["starts"] = ["model_frame"]
PARTS["slots"] = """
        SELECT series_id, origin, h, start + (h - 1) * INTERVAL 15 MINUTE AS ts,
               CASE WHEN h = 1 THEN base_last END AS base_first
        FROM starts CROSS JOIN range(1, 97) t(h)"""
NEEDS["slots"] = ["starts"]
# The fixed linear model; calendar of a forecast stamp: hour local, the rest UTC.
PARTS["scores"] = """
        SELECT s.series_id, s.origin, s.h, s.ts,
               4.0::DOUBLE + 1.5 * cos(2 * pi() * hour(timezone('Europe/Zurich', timezone('UTC', s.ts))) / 24)
               - 0.75 * sin(2 * pi() * (isodow(s.ts) - 1) / 7) + 0.05 * weekofyear(s.ts)
               + 0.5 * (isodow(s.ts) < 6)::INT + 0.02 * coalesce(w.temp_2m_lag15, 0)
               + 0.01 * coalesce(s.base_first, 0) AS score
        FROM slots s ASOF LEFT JOIN model_frame w ON s.series_id = w.series_id AND s.ts >= w.ts"""
NEEDS["scores"] = ["slots"]
PARTS["table_scores"] = """
        SELECT s.series_id, s.origin, s.h, s.ts,
               4.0::DOUBLE + 1.5 * cos(2 * pi() * local_hour / 24) - 0.75 * sin(2 * pi() * weekday / 7) + 0.05 * week
               + 0.5 * is_workday + 0.02 * coalesce(w.temp_2m_lag15, 0)
               + 0.01 * coalesce(w.base_customers_lag_15m, 0) AS score
        FROM slots s JOIN model_frame w USING (series_id, ts)"""
NEEDS["table_scores"] = ["slots"]


def recursion(scores: str, body: str) -> str:
    """Advance every block by one slot per round; a block without a next score stops."""
    return with_parts(
        body,
        scores,
        recursive=True,
        run=f"""
        SELECT series_id, origin, 0::BIGINT AS h, NULL::TIMESTAMP AS ts, hist, NULL::DOUBLE AS yhat FROM starts
        UNION ALL
        SELECT series_id, origin, h, ts, list_append(hist[2:], yhat), yhat FROM (
            SELECT r.series_id, r.origin, s.h, s.ts, r.hist,
                   s.score + 0.25 * r.hist[96] + 0.2 * r.hist[93] + 0.4 * r.hist[1]
                   - 0.1 * (r.hist[96] - r.hist[95]) AS yhat
            FROM run r JOIN {scores} s ON s.series_id = r.series_id AND s.origin = r.origin AND s.h = r.h + 1)""",
    )


SQL["recursive_linear_24h"] = recursion(
    "scores", f"SELECT series_id, origin, h, ts, {r6('yhat')} FROM run WHERE h > 0")
SQL["recursive_table_linear"] = recursion(
    "table_scores", f"SELECT series_id, origin, h, ts, {r6('yhat')} FROM run WHERE h > 0")
SQL["recursive_linear_blocks"] = recursion("scores", f"""
    SELECT series_id, origin, count(y) AS n_used, {BLOCK_METRICS}
    FROM (SELECT r.series_id, r.origin, r.yhat, j.load_kwh AS y FROM run r LEFT JOIN model_frame j USING (series_id, ts) WHERE h > 0)
    GROUP BY 1, 2 HAVING count(y) >= 10 AND count(*) - count(y) <= 4""")
SQL["next_day_forecast"] = recursion("scores", f"""
    SELECT series_id, origin, h, ts, {r6('yhat')} FROM run WHERE h > 0 AND (series_id, origin) IN (
        SELECT (series_id, max(ts)) FROM model_frame
        WHERE right(local_time, 5) = '00:00' AND local_hour = 0 GROUP BY series_id)""")
SQL["next_day_stored"] = SQL["next_day_forecast"]
SQL["next_day_runs"] = recursion("scores", f"""
    SELECT series_id, origin, h, ts, {r6('yhat')} FROM run WHERE h > 0 AND (series_id, origin) IN (
        SELECT (series_id, unnest(max(ts, 2))) FROM model_frame
        WHERE right(local_time, 5) = '00:00' AND local_hour = 0 GROUP BY series_id)""")
define("direct_linear_weights", f"""
    SELECT h, {r6('regr_intercept(b.load_kwh, a.load_kwh)', 'intercept')}, {r6('regr_slope(b.load_kwh, a.load_kwh)', 'slope')}
    FROM pos a CROSS JOIN range(1, 97) t(h) JOIN pos b ON a.series_id = b.series_id AND b.pos = a.pos + h
    WHERE a.pos + 96 < a.n_rows GROUP BY h""", "pos")

# With an intercept, the mean forecast of the fitted rows is the mean of their targets.
define("direct_linear_optimality", f"""
    SELECT h, count(*) AS n_rows, {r6('avg(b.load_kwh)', 'mean_forecast')}, 0.0::DOUBLE AS slope_left
    FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM model_frame) a CROSS JOIN range(1, 97) t(h)
    JOIN model_frame b ON a.series_id = b.series_id AND b.p = a.p + h
    WHERE a.p < floor((a.n - 96) * 0.7::DOUBLE) GROUP BY h""", "model_frame")

# --- boosted trees for each horizon ---------------------------------------------------------

# The plan of the query in plain numbers: two rounds of trees of four leaves, so of three layers at most.
TREE_COLUMNS, TREE_ROUNDS, TREE_LEAVES, TREE_STEP, TREE_ROWS = ("weekday", "day", "week"), 2, 4, 0.3, 20


def _layer(before: str, now: str) -> dict[str, str]:
    """Rows with their leaf after the best leaves of ``before`` took their best split, as many as the budget allows."""
    cells = ", ".join(f"({i}, {c})" for i, c in enumerate(TREE_COLUMNS))
    return {
        f"{now}_cells": f"""
        SELECT h, leaf, f, v, count(*) AS n, sum(g) AS g
        FROM {before}, LATERAL (VALUES {cells}) AS c(f, v) GROUP BY ALL""",
        f"{now}_sums": f"""
        SELECT h, leaf, f, v, sum(n) OVER up AS nl, sum(g) OVER up AS gl, sum(n) OVER every AS n, sum(g) OVER every AS g
        FROM {now}_cells WINDOW up AS (PARTITION BY h, leaf, f ORDER BY v), every AS (PARTITION BY h, leaf, f)""",
        f"{now}_best": f"""
        SELECT h, leaf, f, v, gain FROM (
          SELECT *, (gl * gl / nl + (g - gl) * (g - gl) / (n - nl) - g * g / n)::FLOAT AS gain
          FROM {now}_sums WHERE nl >= {TREE_ROWS} AND n - nl >= {TREE_ROWS})
        WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY h, leaf ORDER BY gain DESC, f, v) = 1""",
        f"{now}_taken": f"""
        SELECT h, leaf, f, v FROM {now}_best JOIN (SELECT h, count(DISTINCT leaf) AS leaves FROM {now}_cells GROUP BY h) USING (h)
        QUALIFY row_number() OVER (PARTITION BY h ORDER BY gain DESC, leaf) <= {TREE_LEAVES} - leaves""",
        now: f"""
        SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.leaf
            ELSE 2 * r.leaf + ([{", ".join("r." + c for c in TREE_COLUMNS)}][b.f + 1] > b.v)::INT END AS leaf)
        FROM {before} r LEFT JOIN {now}_taken b ON r.h = b.h AND r.leaf = b.leaf""",
    }


PARTS["tree0"] = f"""
        SELECT h, {", ".join(TREE_COLUMNS)}, 1 AS leaf, b.load_kwh AS y, avg(b.load_kwh) OVER (PARTITION BY h) AS yhat,
               b.load_kwh - avg(b.load_kwh) OVER (PARTITION BY h) AS g
        FROM pos a JOIN load l ON a.series_id = l.series_id AND a.ts = l.ts
        CROSS JOIN range(1, 97) t(h) JOIN pos b ON a.series_id = b.series_id AND b.pos = a.pos + h
        WHERE a.pos + 96 < a.n_rows"""
_trees = ["tree0"]
for _round in range(TREE_ROUNDS):
    for _depth in "abc":
        _parts = _layer(_trees[-1], f"tree{_round + 1}{_depth}")
        PARTS |= _parts
        _trees += _parts
    PARTS[f"tree{_round + 1}"] = f"""
        SELECT * REPLACE (1 AS leaf, yhat + {TREE_STEP} * avg(g) OVER own AS yhat, g - {TREE_STEP} * avg(g) OVER own AS g)
        FROM {_trees[-1]} WINDOW own AS (PARTITION BY h, leaf)"""
    _trees.append(f"tree{_round + 1}")
define("direct_each_trees", f"""
    SELECT h, count(*) AS n_rows, {r6('avg(abs(g))', 'mae')}, {r6('sqrt(avg(g * g))', 'rmse')},
           {r6('min(yhat)', 'least')}, {r6('max(yhat)', 'most')}
    FROM {_trees[-1]} GROUP BY h""", "load", "pos", *_trees, recursive=True)

# --- permutation importance of the fixed linear model -------------------------------------

# Weight and value of every feature of the fixed model; a missing value counts as 0.
FIXED_TERMS = {
    "hour_cos": (1.5, "cos(2 * pi() * local_hour / 24)"),
    "weekday_sin": (-0.75, "sin(2 * pi() * weekday / 7)"),
    "week": (0.05, "week::DOUBLE"),
    "is_workday": (0.5, "is_workday::DOUBLE"),
    "temp_2m_lag15": (0.02, "coalesce(temp_2m_lag15, 0)"),
    "base_customers_lag_15m": (0.01, "coalesce(base_customers_lag_15m, 0)"),
    "lag_15m": (0.25, "lag_15m"),
    "lag_1h": (0.2, "lag_1h"),
    "lag_24h": (0.4, "lag_24h"),
    "diff_15m": (-0.1, "diff_15m"),
}
_vector = "[" + ", ".join(f"{w} * {x}" for w, x in FIXED_TERMS.values()) + "]"
_names = "[" + ", ".join(f"'{n}'" for n in FIXED_TERMS) + "]"
PARTS["test_rows"] = f"""
        SELECT series_id, ts, load_kwh AS y, {_vector} AS terms, p - floor(n * 0.7::DOUBLE)::BIGINT AS i, n,
               p, local_hour, local_time
        FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM model_frame)
        WHERE p >= floor(n * 0.7::DOUBLE)"""
NEEDS["test_rows"] = ["model_frame"]


def shuffled(source: str, repeats: int) -> dict[str, str]:
    """Each row of ``source(series_id, ts, i, terms)`` with the terms of its donor, per repeat."""
    return {
        "drawn": f"""SELECT series_id, terms, repeat, row_number() OVER (PARTITION BY series_id, repeat
                 ORDER BY md5('42|' || series_id || '|' || repeat || '|' || epoch(ts)::BIGINT)) - 1 AS i
                 FROM {source} CROSS JOIN range(1, {repeats + 1}) t(repeat)""",
        "donated": f"""SELECT s.*, d.repeat, d.terms AS donor FROM {source} s JOIN drawn d
                 ON d.series_id = s.series_id AND d.i = s.i""",
    }


def ranked_changes(prefix: str) -> str:
    mean, std = {"importance": ("importance_mean", "importance_std"),
                 "delta": ("delta_rmse_mean", "delta_rmse_std")}[prefix]
    return f"""SELECT feature, {r6('avg(change)', mean)}, {r6('stddev_pop(change)', std)}
               FROM changes GROUP BY feature"""


define("score_absent_feature", f"""
    SELECT series_id, ts, {r6(f'4.0::DOUBLE + list_sum({_vector}) - 0.02 * coalesce(temp_2m_lag15, 0)', 'yhat')}
    FROM model_frame""", "model_frame")
define("model_save_load", """
    SELECT CASE WHEN p < floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, 0.0::DOUBLE AS max_diff
    FROM (SELECT p, count(*) OVER (PARTITION BY series_id) AS n FROM model_frame) GROUP BY 1""", "model_frame")
define("perm_importance_fixed_model", ranked_changes("importance"), "test_rows",
       tail=f"""SELECT series_id, ts, y, terms, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS i
                FROM test_rows""",
       **shuffled("tail", 10),
       base="SELECT sqrt(avg((y - 4.0::DOUBLE - list_sum(terms)) ^ 2)) AS rmse FROM tail",
       changes=f"""SELECT feature, repeat, sqrt(avg((y - 4.0::DOUBLE - list_sum(terms) + terms[f] - donor[f]) ^ 2))
                          - any_value(rmse) AS change
                   FROM donated CROSS JOIN (SELECT unnest({_names}) AS feature, unnest(range(1, 11)) AS f) CROSS JOIN base
                   GROUP BY feature, repeat""")

_outside = "list_sum(terms[1:6])"
SQL["perm_importance_fixed_recursion"] = with_parts(
    ranked_changes("delta"), "test_rows", "starts", "model_frame", recursive=True,
    **shuffled("test_rows", 5),
    picked=f"""SELECT series_id, ts AS origin FROM test_rows
               WHERE right(local_time, 5) = '00:00' AND local_hour = 0""",
    begun="SELECT s.* FROM starts s JOIN picked USING (series_id, origin)",
    variants=f"""
        SELECT series_id, ts, 'none' AS feature, 0::BIGINT AS repeat, {_vector} AS terms FROM model_frame
        UNION ALL
        SELECT series_id, ts, feature, repeat,
               list_transform(range(1, 11), lambda k: CASE WHEN k = f THEN donor[k] ELSE terms[k] END)
        FROM donated CROSS JOIN (SELECT unnest({_names}) AS feature, unnest(range(1, 11)) AS f)""",
    steps=f"""
        SELECT b.series_id, b.origin, v.feature, v.repeat, h, v.ts, 4.0::DOUBLE + {_outside} AS score
        FROM (SELECT *, unnest(range(1, 97)) AS h FROM begun) b JOIN variants v
          ON v.series_id = b.series_id AND v.ts = b.start + (h - 1) * INTERVAL 15 MINUTE""",
    run="""
        SELECT series_id, origin, feature, repeat, 0::BIGINT AS h, NULL::TIMESTAMP AS ts, hist, NULL::DOUBLE AS yhat
        FROM begun CROSS JOIN (SELECT DISTINCT feature, repeat FROM steps)
        UNION ALL
        SELECT series_id, origin, feature, repeat, h, ts, list_append(hist[2:], yhat), yhat FROM (
            SELECT r.series_id, r.origin, r.feature, r.repeat, s.h, s.ts, r.hist,
                   s.score + 0.25 * r.hist[96] + 0.2 * r.hist[93] + 0.4 * r.hist[1]
                   - 0.1 * (r.hist[96] - r.hist[95]) AS yhat
            FROM run r JOIN steps s ON s.series_id = r.series_id AND s.origin = r.origin
              AND s.feature = r.feature AND s.repeat = r.repeat AND s.h = r.h + 1)""",
    block_errors="""
        SELECT r.feature, r.repeat, sqrt(avg((j.load_kwh - r.yhat) ^ 2)) AS rmse
        FROM run r LEFT JOIN model_frame j USING (series_id, ts) WHERE r.h > 0
        GROUP BY r.series_id, r.origin, r.feature, r.repeat HAVING count(j.load_kwh) >= 10 AND count(*) - count(j.load_kwh) <= 4""",
    scores_by="SELECT feature, repeat, avg(rmse) AS score FROM block_errors GROUP BY 1, 2",
    changes="""SELECT feature, score - (SELECT score FROM scores_by WHERE feature = 'none') AS change
               FROM scores_by WHERE feature <> 'none'""",
)

# --- daily model ---------------------------------------------------------------------------

# Columns: intercept, trend with 25 changes, 3 weekly and 10 yearly waves, and the holidays.
SQL["daily_seasonal_gradient"] = """
    SELECT series_id, unnest(range(0, 1 + 26 + 6 + 20 + 4)) AS "column", 0.0::DOUBLE AS gradient
    FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders)"""
# Series with at least one training day: the first floor(0.7 n) of the days that the filled grid covers.
define("daily_load_gradient", """
    SELECT series_id, unnest(range(0, 1 + 26 + 6 + 20 + 4)) AS "column", 0.0::DOUBLE AS gradient
    FROM (SELECT series_id FROM (
        SELECT series_id FROM axis
        GROUP BY series_id, strftime(timezone('Europe/Zurich', timezone('UTC', ts)), '%Y-%m-%d') HAVING count(*) = 96)
      GROUP BY series_id HAVING floor(count(*) * 0.7::DOUBLE) >= 1)""", "axis")
