"""DuckDB oracle SQL per registered key (see ``oracle`` for the shared CTEs)."""

from __future__ import annotations

import json
from collections import namedtuple

from .oracle import (DQ_SELECT, LEDGER_TYPES, RAW_LEDGER_COLUMNS, columns_observed, dq_count_row,
                     dq_rowcount_row, dq_static_row, lit, money_avg, money_sum, q, rnd, rolling, sql, with_)

ORACLE: dict[str, str] = {}

# ------------------------------------------------------------------ column names and types
CUSTOMER_EXTRACT_COLUMNS = ["Customer ID", "Customer Name", "Segment", "Country", "City", "State",
                            "Postal Code", "Region"]
WEATHER_COLUMNS = ["temp_c", "precipitation_mm", "snowfall_cm", "wind_speed_kmh"]
DB_COLUMNS = ["db_customer_name", "db_segment", "db_city", "db_state", "db_region"]
ROW_FEATURES = ["holiday_flag", "month", "year", "quarter", "weekend_flag", "profit_margin",
                "back_to_school_flag"]
DAY_FEATURES = ["days_until_next_holiday", "days_since_last_holiday",
                "holiday_shopping_season_flag", "rolling_sales_7d", "rolling_sales_30d"]
WEATHER_FLAGS = ["is_raining", "is_snowing", "extreme_weather_flag"]
FOLDED = {c: c.lower().replace(" ", "_").replace("-", "_") for c in RAW_LEDGER_COLUMNS}
RAW_TYPES = dict(LEDGER_TYPES)
CLEAN_TYPES = dict(LEDGER_TYPES, **{"Order Date": "date"})
WIDE_COLUMNS = (["Order Date"] + [c for c in RAW_LEDGER_COLUMNS if c != "Order Date"] + DB_COLUMNS
                + ["holiday_name", "holiday_date"] + WEATHER_COLUMNS + ROW_FEATURES + DAY_FEATURES + WEATHER_FLAGS)
WIDE_TYPES = dict(CLEAN_TYPES, **{c: "string" for c in DB_COLUMNS},
                  holiday_name="string", holiday_date="date",
                  **{c: "double" for c in WEATHER_COLUMNS},
                  **{c: "int" for c in ROW_FEATURES + WEATHER_FLAGS + DAY_FEATURES[:3]})
WIDE_TYPES.update(profit_margin="double", rolling_sales_7d="double", rolling_sales_30d="double")
HOL_TYPES = {"holiday_name": "string", "holiday_date": "date"}
WEATHER_TYPES = {"weather_region": "string", "weather_date": "string",
                 **{c: "double" for c in WEATHER_COLUMNS}}
REGIONS = [("Central", 41.8781, -87.6298, "Chicago"), ("East", 40.7128, -74.0060, "New York"),
           ("South", 33.7490, -84.3880, "Atlanta"), ("West", 34.0522, -118.2437, "Los Angeles")]

# ------------------------------------------------------------------ the rules, written out
R = namedtuple("R", "expectation_type kind column params")


def _columns(*names):
    return R("expect_table_columns_to_match_set", "columns", None, (names, False))


def _rows(lo, hi):
    return R("expect_table_row_count_to_be_between", "row_count", None, (lo, hi))


def _not_null(c):
    return R("expect_column_values_to_not_be_null", "not_null", c, ())


def _type(c, name):
    return R("expect_column_values_to_be_of_type", "type", c, (name,))


def _between(c, lo, hi, dates=False):
    return R("expect_column_values_to_be_between", "between", c, (lo, hi, dates))


def _in_set(c, *values):
    return R("expect_column_values_to_be_in_set", "in_set", c, (values,))


def _gte(c, value):
    return R("expect_column_values_to_be_greater_than_or_equal_to", "gte", c, (value,))


LEDGER_RULES = {
    "dq_not_null": [_not_null("Order ID"), _not_null("Order Date"), _not_null("missing")],
    "dq_between": [_between("Quantity", 1, 50), _between("Quantity", 10, 40), _between("Discount", 0.0, 0.05)],
    "dq_between_date": [_between("Order Date", "1995-01-01", "2001-12-31", True),
                        _between("Order Date", "1996-01-01", "1999-12-31", True),
                        _between("Ship Date", "1995-01-01", "2001-06-30", True)],
    "dq_in_set": [_in_set("Segment", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
                  _in_set("Segment", "AUTOMOBILE", "BUILDING")],
    "dq_gte": [_gte("Sales", 0.0), _gte("Profit", 0.0), _gte("Quantity", 25)],
    "dq_row_count": [_rows(1, 10 ** 12), _rows(5000, 15000)],
}
SUITE_RULES = {
    "raw_sales": [
        _columns(*RAW_LEDGER_COLUMNS), _rows(5000, 15000),
        _not_null("Order ID"), _not_null("Customer ID"), _not_null("Order Date"), _not_null("Sales"),
        _gte("Sales", 0.0), _gte("Quantity", 1), _between("Order Date", "1995-01-01", "2001-12-31", True)],
    "raw_holidays": [
        _columns("holiday_name", "holiday_date"), _not_null("holiday_name"), _not_null("holiday_date"),
        _between("holiday_date", "1995-01-01", "2001-12-31", True), _rows(10, 150)],
    "raw_weather": [
        _columns("weather_region", "weather_date", "temp_c", "precipitation_mm", "snowfall_cm", "wind_speed_kmh"),
        _not_null("weather_date"), _not_null("weather_region"),
        _in_set("weather_region", "Central", "East", "South", "West"),
        _between("temp_c", -50.0, 50.0), _gte("precipitation_mm", 0.0), _gte("snowfall_cm", 0.0)],
    "final_analytics": [
        _columns("Order Date", "Customer ID", "Sales", "Profit", "holiday_name", "holiday_flag", "month", "year",
                 "quarter", "weekend_flag", "profit_margin", "temp_c", "precipitation_mm", "snowfall_cm",
                 "wind_speed_kmh", "is_raining", "is_snowing", "extreme_weather_flag", "days_until_next_holiday",
                 "days_since_last_holiday", "holiday_shopping_season_flag", "rolling_sales_7d", "rolling_sales_30d"),
        _type("Sales", "numeric"), _type("Profit", "numeric"), _type("holiday_flag", "integer"),
        _in_set("holiday_flag", 0, 1), _in_set("weekend_flag", 0, 1), _in_set("is_raining", 0, 1),
        _in_set("is_snowing", 0, 1), _in_set("extreme_weather_flag", 0, 1),
        _in_set("holiday_shopping_season_flag", 0, 1),
        _between("month", 1, 12), _between("quarter", 1, 4), _between("year", 1995, 2001),
        _between("profit_margin", -1000.0, 100.0), _gte("days_until_next_holiday", 0),
        _gte("days_since_last_holiday", 0), _not_null("rolling_sales_7d")],
}
INT_FAMILY = {"tinyint", "smallint", "int", "bigint"}
FAMILIES = {
    "numeric": INT_FAMILY | {"double", "float", "boolean"} | {"decimal"},
    "integer": INT_FAMILY,
    "string": {"string"}, "object": {"string"},
    "datetime": {"date", "timestamp", "timestamp_ntz"},
    "boolean": {"boolean"},
}


# ------------------------------------------------------------------ quality rules -> SQL
def _bad(rule, types):
    c, t = q(rule.column), types[rule.column]
    v = f"(CASE WHEN NOT isnan({c}) THEN {c} END)" if t == "double" else c
    if rule.kind == "not_null":
        return f"{c} IS NULL" + (f" OR isnan({c})" if t == "double" else f" OR {c} = ''" if t == "string" else ""), None
    if rule.kind == "between":
        lo, hi, parse_date = rule.params
        if parse_date:
            ts = (f"CAST({c} AS TIMESTAMP)" if t in ("date", "timestamp", "timestamp_ntz") else
                  f"coalesce(TRY_CAST({c} AS TIMESTAMP), try_strptime({c}, '%m/%d/%Y'))")
            return (f"{ts} IS NOT NULL AND ({ts} < TIMESTAMP '{lo}' OR {ts} > TIMESTAMP '{hi}')",
                    f"CAST({ts} AS VARCHAR)")
        return f"{v} IS NOT NULL AND ({v} < {lo!r} OR {v} > {hi!r})", f"CAST({v} AS VARCHAR)"
    if rule.kind == "in_set":
        (allowed,) = rule.params
        return (f"{v} IS NOT NULL AND {v} NOT IN ({', '.join(lit(a) for a in allowed)})",
                f"CAST({v} AS VARCHAR)")
    if rule.kind == "gte":
        (value,) = rule.params
        return f"{v} IS NOT NULL AND {v} < {value!r}", f"CAST({v} AS VARCHAR)"
    raise ValueError(rule.kind)


def dq_rows(dataset, source, rules, types, columns):
    """Union of per-rule result rows for ``rules`` over CTE ``source``."""
    counts, rows = ["COUNT(*) AS n"], []
    for i, r in enumerate(rules):
        missing = r.column is not None and r.column not in columns
        if r.kind == "columns":
            expected, ordered = r.params
            ok = list(expected) == columns if ordered else set(expected) <= set(columns)
            rows.append(dq_static_row(dataset, i, r.expectation_type, None, ok,
                                      columns_observed(columns, list(expected))))
        elif r.kind == "exists":
            rows.append(dq_static_row(dataset, i, r.expectation_type, r.column,
                                      r.column in columns, json.dumps(columns)))
        elif missing:
            rows.append(dq_static_row(dataset, i, r.expectation_type, r.column, False,
                                      None, "Column not found"))
        elif r.kind == "type":
            t = types[r.column]
            ok = t in FAMILIES.get(r.params[0], set())
            rows.append(dq_static_row(dataset, i, r.expectation_type, r.column, ok, t))
        elif r.kind == "row_count":
            rows.append(dq_rowcount_row(dataset, i, *r.params))
        else:
            bad, _ = _bad(r, types)
            counts.append(f"COUNT(*) FILTER (WHERE {bad}) AS u{i}")
            rows.append(dq_count_row(dataset, i, r.expectation_type, r.column, bad))
    cte = f"counts AS (SELECT {', '.join(counts)} FROM {source})"
    return cte, " UNION ALL ".join(f"({x})" for x in rows)


def dq_query(deps, dataset, source, rules, types, columns):
    cte, body = dq_rows(dataset, source, rules, types, columns)
    return with_(*deps)[:-1] + ",\n" + cte + f"\nSELECT {DQ_SELECT} FROM ({body})"


CLEAN_COLUMNS = list(RAW_LEDGER_COLUMNS)
for _key, _rules in LEDGER_RULES.items():
    ORACLE[_key] = dq_query(["clean"], "ledger", "clean", _rules, CLEAN_TYPES, CLEAN_COLUMNS)

SUITES = {
    "raw_sales": (["raw"], "raw", RAW_TYPES, CLEAN_COLUMNS, ["Row ID"]),
    "raw_holidays": (["hol"], "hol", HOL_TYPES, ["holiday_name", "holiday_date"],
                     ["holiday_date", "holiday_name"]),
    "raw_weather": (["weather"], "weather", WEATHER_TYPES, list(WEATHER_TYPES),
                    ["weather_region", "weather_date"]),
    "final_analytics": (["wide"], "wide", WIDE_TYPES, WIDE_COLUMNS, ["Row ID"]),
}


def suite_sql(name):
    deps, source, types, columns, _ = SUITES[name]
    return dq_query(deps, name, source, SUITE_RULES[name], types, columns)


ORACLE["dq_suite_sales"] = suite_sql("raw_sales")
ORACLE["dq_suite_holidays"] = suite_sql("raw_holidays")
ORACLE["dq_suite_weather"] = suite_sql("raw_weather")
ORACLE["dq_suite_final"] = suite_sql("final_analytics")


def _all_suites_body():
    deps, parts, ctes = ["raw", "hol", "weather", "wide"], [], []
    for k, name in enumerate(SUITES):
        _, source, types, columns, _ = SUITES[name]
        cte, body = dq_rows(name, source, SUITE_RULES[name], types, columns)
        ctes.append(cte.replace("counts AS", f"counts{k} AS", 1))
        parts.append(body.replace("FROM counts", f"FROM counts{k}"))
    return with_(*deps)[:-1] + ",\n" + ",\n".join(ctes) + "\n", " UNION ALL ".join(parts)


_head, _body = _all_suites_body()
ORACLE["dq_results"] = _head + f"SELECT {DQ_SELECT} FROM ({_body})"
ORACLE["dq_summary"] = _head + f"""SELECT total_checks, passed_checks, total_checks - passed_checks AS failed_checks,
  pct AS pass_percent,
  CASE WHEN pct >= 90.0 THEN 'Healthy' WHEN pct >= 75.0 THEN 'Warning' ELSE 'Unhealthy' END AS status
FROM (SELECT *, CASE WHEN total_checks > 0 THEN {rnd('passed_checks * 100.0 / total_checks', 1)} ELSE 0.0 END AS pct
      FROM (SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE success) AS passed_checks
            FROM ({_body})))"""


def _samples(name):
    deps, source, types, columns, order = SUITES[name]
    parts = []
    for i, r in enumerate(SUITE_RULES[name]):
        if r.kind not in ("between", "in_set", "gte") or r.column not in columns:
            continue
        bad, shown = _bad(r, types)
        keys = ", ".join([f"{q(c)} ASC NULLS FIRST" for c in order] + [f"{shown} ASC NULLS FIRST"])
        parts.append(f"""SELECT {lit(name)} AS dataset, CAST({i} AS INTEGER) AS rule_id,
            CAST(rn - 1 AS INTEGER) AS sample_pos, value FROM (
              SELECT {shown} AS value, row_number() OVER (ORDER BY {keys}) AS rn
              FROM {source} WHERE {bad}) WHERE rn <= 10""")
    return deps, parts


_d1, _p1 = _samples("raw_sales")
_d2, _p2 = _samples("raw_weather")
ORACLE["dq_samples"] = with_(*(_d1 + _d2)) + " UNION ALL ".join(f"({p})" for p in _p1 + _p2)

# ------------------------------------------------------------------ sources / sinks
ORACLE["csv_roundtrip"] = sql(["raw"], "SELECT * FROM raw")
ORACLE["clean_sales_typed"] = sql(["raw"], """SELECT * REPLACE (
  CASE WHEN "Ship Mode" = '1-URGENT' THEN NULL ELSE "Quantity" END AS "Quantity",
  CASE WHEN "Ship Mode" = '2-HIGH' THEN NULL ELSE "Sales" END AS "Sales") FROM raw""")
ORACLE["json_holidays_scan"] = sql(["hol"], "SELECT holiday_name, holiday_date FROM hol")
ORACLE["json_weather_scan"] = sql(["weather"], "SELECT * FROM weather")
ORACLE["flatten_weather"] = ORACLE["json_weather_scan"]
ORACLE["holiday_join_missing_source"] = sql(["clean"], """SELECT "Row ID", "Order Date",
  CAST(NULL AS VARCHAR) AS holiday_name, CAST(NULL AS DATE) AS holiday_date, 0 AS holiday_flag,
  CAST(NULL AS INTEGER) AS days_until_next_holiday, CAST(NULL AS INTEGER) AS days_since_last_holiday,
  0 AS holiday_shopping_season_flag FROM clean""")
_lk = ", ".join(f"({lit(r)}, {a!r}, {b!r}, {lit(c)})" for r, a, b, c in REGIONS)
ORACLE["region_lookup"] = sql(["raw"], f"""SELECT x."Region", x.line_count, CAST(lk.lat AS DOUBLE) AS lat, CAST(lk.lon AS DOUBLE) AS lon, lk.city
FROM (SELECT "Region", COUNT(*) AS line_count FROM raw GROUP BY 1) x
LEFT JOIN (VALUES {_lk}) lk(region, lat, lon, city) ON x."Region" = lk.region""")
ORACLE["dim_key_unique"] = sql(["dim"], """SELECT COUNT(*) AS row_count,
  COUNT(*) FILTER (WHERE customer_id IS NULL) AS null_keys,
  (SELECT COUNT(*) FROM (SELECT customer_id FROM dim WHERE customer_id IS NOT NULL
                         GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys,
  COUNT(DISTINCT customer_id) AS distinct_keys FROM dim""")

# ------------------------------------------------------------------ joins / reshape
ORACLE["join_sales_customers"] = sql(["joined"], "SELECT * FROM joined")
ORACLE["join_sales_holidays"] = sql(["sh"], 'SELECT "Row ID", "Order Date", holiday_name, holiday_date FROM sh')
ORACLE["join_sales_weather"] = sql(["joined", "weather"], """SELECT j."Row ID", j."Order Date",
  j."Customer ID", j."Region", j.db_region, w.temp_c, w.precipitation_mm, w.snowfall_cm, w.wind_speed_kmh
FROM joined j LEFT JOIN weather w ON j."Order Date" = TRY_CAST(w.weather_date AS DATE)
  AND coalesce(j.db_region, j."Region") = w.weather_region""")
_FLAG = "CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END AS holiday_flag"
ORACLE["sales_with_holidays"] = sql(["sh"], f'SELECT "Row ID", "Order Date", holiday_name, holiday_date, {_FLAG} FROM sh')
ORACLE["holiday_flag"] = sql(["sh"], f'SELECT "Row ID", "Order Date", holiday_name, {_FLAG} FROM sh')
ORACLE["flatten_holidays"] = sql(["docs_flat"], """SELECT name AS holiday_name,
  TRY_CAST(substr(iso, 1, 10) AS DATE) AS holiday_date FROM docs_flat""")
ORACLE["holiday_types"] = sql(["docs_flat"], """SELECT name AS holiday_name, iso AS holiday_date,
  primary_type AS holiday_type FROM docs_flat""")
ORACLE["filter_dedup_holidays"] = sql(["fd"], "SELECT year, position, name, iso, primary_type FROM fd")
ORACLE["union_weather"] = sql(["weather"], """SELECT weather_region, weather_date, temp_c, precipitation_mm,
  CAST(NULL AS DOUBLE) AS snowfall_cm, CAST(NULL AS DOUBLE) AS wind_speed_kmh FROM weather
UNION ALL SELECT weather_region, weather_date, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  snowfall_cm, wind_speed_kmh FROM weather""")

# ------------------------------------------------------------------ columns / cleaning
ORACLE["clean_sales"] = sql(["clean"], "SELECT * FROM clean")
ORACLE["normalize_columns"] = sql(["clean"], "SELECT " + ", ".join(
    f"{q(c)} AS {FOLDED[c]}" for c in RAW_LEDGER_COLUMNS) + " FROM clean")
ORACLE["rename_positional"] = sql(["raw"], "SELECT DISTINCT " + ", ".join(
    f"{q(c)} AS {n}" for c, n in zip(CUSTOMER_EXTRACT_COLUMNS,
                                     ["customer_id", "customer_name", "segment", "country", "city",
                                      "state", "postal_code", "region"])) + " FROM raw")
ORACLE["extract_customers"] = sql(["raw"], "SELECT DISTINCT " + ", ".join(q(c) for c in CUSTOMER_EXTRACT_COLUMNS) + " FROM raw")
ORACLE["coerce_dates"] = sql(["clean"], """SELECT "Row ID" AS row_id, CAST("Order Date" AS TIMESTAMP) AS order_date,
  coalesce(TRY_CAST("Ship Date" AS TIMESTAMP), try_strptime("Ship Date", '%m/%d/%Y')) AS ship_date FROM clean""")
ORACLE["weather_flags_missing_cols"] = sql(["sh"], """SELECT "Row ID", CAST(NULL AS DOUBLE) AS temp_c,
  CAST(NULL AS DOUBLE) AS precipitation_mm, CAST(NULL AS DOUBLE) AS snowfall_cm,
  CAST(NULL AS DOUBLE) AS wind_speed_kmh, 0 AS is_raining, 0 AS is_snowing, 0 AS extreme_weather_flag FROM sh""")

# ------------------------------------------------------------------ row features
ORACLE["date_parts"] = sql(["clean"], """SELECT "Row ID", "Order Date",
  CAST(month("Order Date") AS INTEGER) AS month, CAST(year("Order Date") AS INTEGER) AS year,
  CAST(quarter("Order Date") AS INTEGER) AS quarter, CAST(day("Order Date") AS INTEGER) AS day_of_month,
  CAST(dayofweek("Order Date") + 1 AS INTEGER) AS day_of_week FROM clean""")
ORACLE["weekend_flag"] = sql(["clean"], """SELECT "Row ID", "Order Date",
  CASE WHEN dayofweek("Order Date") IN (0, 6) THEN 1 ELSE 0 END AS weekend_flag FROM clean""")
ORACLE["back_to_school_flag"] = sql(["clean"], """SELECT "Row ID", "Order Date",
  CASE WHEN month("Order Date") = 7 AND day("Order Date") >= 15 THEN 1
       WHEN month("Order Date") = 8 THEN 1 ELSE 0 END AS back_to_school_flag FROM clean""")
ORACLE["profit_margin"] = sql(["clean"], f"""SELECT "Row ID", "Sales", "Profit",
  {rnd('"Profit" / NULLIF("Sales", 0) * 100', 2)} AS profit_margin FROM clean""")
ORACLE["weather_flags"] = sql(["wide"], """SELECT "Row ID", "Order Date", precipitation_mm, snowfall_cm,
  wind_speed_kmh, is_raining, is_snowing, extreme_weather_flag FROM wide""")

# ------------------------------------------------------------------ day-grain features
ORACLE["daily_sales"] = sql(["daily"], """SELECT d AS "Order Date",
  CAST(CAST(total AS VARCHAR) AS DOUBLE) AS total_daily_sales FROM daily""")
ORACLE["rolling_sales_by_region"] = sql(["regional"], f"""SELECT r AS "Region", d AS "Order Date",
  {rnd(rolling("w7"), 2)} AS rolling_sales_7d, {rnd(rolling("w30"), 2)} AS rolling_sales_30d
FROM (SELECT *, date_diff('day', DATE '1970-01-01', d) AS dn FROM regional)
WINDOW w7 AS (PARTITION BY r ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY r ORDER BY dn RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""")
ORACLE["rolling_sales"] = sql(["feat"], 'SELECT "Row ID", "Order Date", rolling_sales_7d, rolling_sales_30d FROM feat')
ORACLE["days_until_next_holiday"] = sql(["feat"], 'SELECT "Row ID", "Order Date", days_until_next_holiday FROM feat')
ORACLE["days_since_last_holiday"] = sql(["feat"], 'SELECT "Row ID", "Order Date", days_since_last_holiday FROM feat')
ORACLE["holiday_shopping_season"] = sql(["feat"], 'SELECT "Row ID", "Order Date", holiday_shopping_season_flag FROM feat')
ORACLE["holiday_proximity_empty"] = sql(["clean"], """SELECT "Row ID", "Order Date",
  CAST(NULL AS INTEGER) AS days_until_next_holiday, CAST(NULL AS INTEGER) AS days_since_last_holiday,
  0 AS holiday_shopping_season_flag FROM clean""")
ORACLE["holiday_calendar"] = sql(["hol"], "SELECT DISTINCT holiday_date FROM hol WHERE holiday_date IS NOT NULL")
ORACLE["thanksgiving_by_year"] = sql(["tg"], "SELECT CAST(y AS INTEGER) AS year, tg AS thanksgiving_date FROM tg")
ORACLE["engineer_features"] = sql(["feat"], "SELECT * FROM feat")
ORACLE["wide_analytics"] = sql(["wide"], "SELECT * FROM wide")
ORACLE["holiday_order_count"] = sql(["wide"], "SELECT COUNT(*) FILTER (WHERE holiday_flag = 1) AS holiday_order_lines FROM wide")

# ------------------------------------------------------------------ profile / dims
ORACLE["row_count"] = sql(["raw"], "SELECT COUNT(*) AS row_count FROM raw")
_MISSING = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, {lit(c)} AS column_name, "
    f"COUNT(*) FILTER (WHERE {q(c)} IS NULL) AS missing_count FROM clean"
    for i, c in enumerate(RAW_LEDGER_COLUMNS))
ORACLE["missing_by_column"] = sql(["clean"], _MISSING)
_ALL = ", ".join(q(c) for c in RAW_LEDGER_COLUMNS)
_DUP = f"SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT COUNT(*) AS n FROM clean GROUP BY {_ALL})"
ORACLE["duplicate_rows"] = sql(["clean"], _DUP)
ORACLE["profile_sales"] = sql(["clean"], f"""SELECT 'row_count' AS metric, CAST(NULL AS VARCHAR) AS column_name,
  COUNT(*) AS value FROM clean
UNION ALL SELECT 'duplicate_rows', NULL, duplicate_rows FROM ({_DUP})
UNION ALL SELECT 'missing', column_name, missing_count FROM ({_MISSING})""")
ORACLE["sample_rows"] = sql(["clean"], "SELECT * FROM clean ORDER BY " + ", ".join(
    f"{q(c)} ASC NULLS FIRST" for c in RAW_LEDGER_COLUMNS) + " LIMIT 10")
_DIMV = ["customer_name", "segment", "city", "state", "region"]


ORACLE["publish_replaces"] = sql(["clean"], """SELECT CAST(year("Order Date") AS INTEGER) AS year,
  COUNT(*) AS line_count FROM clean WHERE year("Order Date") >= 1997 GROUP BY 1""")
ORACLE["publish_keeps_old"] = sql(["clean"], """SELECT CAST(year("Order Date") AS INTEGER) AS year, COUNT(*) AS first_lines,
  CASE WHEN year("Order Date") >= 1997 THEN COUNT(*) END AS second_lines FROM clean GROUP BY year("Order Date")""")
ORACLE["csv_misordered_parts"] = sql(["raw"], "SELECT * REPLACE (CASE WHEN \"Ship Mode\" = '2-HIGH' THEN NULL ELSE \"Postal Code\" END"
                                     " AS \"Postal Code\") FROM raw")
ORACLE["holidays_tolerant"] = sql(["fd"], """SELECT name AS holiday_name, TRY_CAST(substr(iso, 1, 10) AS DATE) AS holiday_date
FROM fd WHERE year NOT IN (1995, 1997)""")
_WORDS = """(SELECT *, row_number() OVER (PARTITION BY weather_region ORDER BY weather_date) % 10 = 4 AND weather_region = 'West' AS odd FROM weather)"""
ORACLE["payload_report"] = sql(["weather", "years"], f"""SELECT CAST(year AS VARCHAR) AS source,
  CASE year WHEN 1995 THEN 'not JSON' WHEN 1997 THEN 'no entries' END AS reason, CAST(CASE year WHEN 1999 THEN 2 ELSE 0 END AS BIGINT) AS skipped
FROM years WHERE year IN (1995, 1997, 1999)
UNION ALL SELECT DISTINCT 'East', 'not JSON', CAST(0 AS BIGINT) FROM weather WHERE weather_region = 'East'
UNION ALL SELECT 'West', NULL, count(*) FROM {_WORDS} WHERE odd HAVING count(*) > 0""")
ORACLE["weather_tolerant"] = sql(["weather"], f"""SELECT * EXCLUDE (odd) REPLACE (CASE WHEN odd THEN NULL ELSE temp_c END AS temp_c)
FROM {_WORDS} WHERE weather_region <> 'East'""")
ORACLE["rolling_sales_from_state"] = sql(["dayt"], "SELECT d AS day, rolling_sales_7d, rolling_sales_30d FROM dayt")
ORACLE["rolling_sales_changed"] = sql(["dayt", "clean"], """SELECT d AS day, rolling_sales_7d, rolling_sales_30d FROM dayt
WHERE EXISTS (SELECT 1 FROM clean WHERE "Ship Mode" = '5-LOW' AND month("Order Date") = 3
  AND dayt.d BETWEEN "Order Date" AND "Order Date" + 29)""")
ORACLE["union_weather_partial"] = sql(["weather"], "SELECT * FROM weather")
ORACLE["load_published"] = sql(["sh"], "SELECT " + ", ".join(
    f"{q(c)} AS {FOLDED[c]}" for c in RAW_LEDGER_COLUMNS if c not in ("Order Date", "Ship Date")) + """,
  CAST("Order Date" AS TIMESTAMP) AS order_date, try_strptime("Ship Date", '%m/%d/%Y') AS ship_date,
  holiday_name, CAST(holiday_date AS TIMESTAMP) AS holiday_date,
  CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END AS holiday_flag FROM sh""")
ORACLE["dq_in_table"] = sql(["raw", "dim"], """SELECT COUNT(*) AS element_count,
  COUNT(*) FILTER (WHERE "Customer ID" IS NOT NULL AND "Customer ID" NOT IN
    (SELECT customer_id FROM dim WHERE region <> 'South')) AS unexpected_count FROM raw""")


def _dim_build(source: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in _DIMV)
    return f"""SELECT customer_id, {', '.join(_DIMV)} FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {order}) AS rn FROM {source}
      WHERE customer_id IS NOT NULL) WHERE rn = 1"""


def _staging(where: str) -> str:
    return f"""SELECT DISTINCT "Customer ID" AS customer_id, "Customer Name" AS customer_name,
      "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state,
      "Postal Code" AS postal_code, "Region" AS region FROM raw WHERE {where}"""


ORACLE["customer_dim_build"] = sql(["raw"], _dim_build(f"({_staging('TRUE')})"))
ORACLE["dim_first_load"] = ORACLE["customer_dim_build"]
_EARLY = "coalesce(\"Ship Mode\" IN ('1-URGENT', '2-HIGH'), FALSE)"
ORACLE["customer_dim_upsert"] = sql(["raw"], f"""SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
  """ + ",\n  ".join(f"CASE WHEN s.customer_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _DIMV) + f"""
FROM ({_dim_build(f"({_staging(_EARLY)})")}) t
FULL OUTER JOIN ({_dim_build(f"({_staging('NOT (' + _EARLY + ')')})")}) s ON t.customer_id = s.customer_id""")

ORACLE["wide_from_stored_dimension"] = ORACLE["wide_analytics"]
ORACLE["dim_merge_in_place"] = ORACLE["customer_dim_upsert"]

# ------------------------------------------------------------------ BI sheets
ORACLE["bi_distinct_by_month"] = sql(["clean"], """SELECT CAST(year("Order Date") AS INTEGER) AS year, CAST(month("Order Date") AS INTEGER) AS month,
  COUNT(DISTINCT "Order ID") AS orders, COUNT(DISTINCT "Customer ID") AS customers FROM clean WHERE "Order Date" IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 0, 0, COUNT(DISTINCT "Order ID"), COUNT(DISTINCT "Customer ID") FROM clean""")
_BI = {
    "bi_sales_trend_by_year": ("year", "year", "Sales", "sum"),
    "bi_sales_by_category": ('"Category"', "category", "Sales", "sum"),
    "bi_profit_by_category": ('"Category"', "category", "Profit", "sum"),
    "bi_sales_by_sub_category": ('"Sub-Category"', "sub_category", "Sales", "sum"),
    "bi_sales_by_segment": ('"Segment"', "segment", "Sales", "sum"),
    "bi_profit_by_segment": ('"Segment"', "segment", "Profit", "sum"),
    "bi_sales_by_region": ('"Region"', "region", "Sales", "sum"),
    "bi_profit_by_region": ('"Region"', "region", "Profit", "sum"),
    "bi_sales_by_state": ('"State"', "state", "Sales", "sum"),
    "bi_profit_by_state": ('"State"', "state", "Profit", "sum"),
    "bi_avg_sales_by_holiday": ("holiday_flag", "holiday_flag", "Sales", "avg"),
    "bi_avg_profit_by_holiday": ("holiday_flag", "holiday_flag", "Profit", "avg"),
    "bi_sales_by_month": ("month", "month", "Sales", "sum"),
    "bi_sales_by_weekend": ("weekend_flag", "weekend_flag", "Sales", "sum"),
}
for _k, (_expr, _name, _m, _how) in _BI.items():
    _agg = money_sum(q(_m)) if _how == "sum" else money_avg(q(_m))
    ORACLE[_k] = sql(["wide"], f"SELECT {_expr} AS {_name}, {_agg} AS {_how}_{_m.lower()} FROM wide GROUP BY 1")
ORACLE["bi_profit_trend_by_year"] = sql(["wide"], f"""SELECT year, {money_sum('"Profit"')} AS sum_profit
FROM wide WHERE year <> 2016 OR year IS NULL GROUP BY 1""")
ORACLE["bi_kpis"] = sql(["wide"], f"""SELECT {money_sum('"Sales"')} AS total_sales,
  {money_sum('"Profit"')} AS total_profit, COUNT(DISTINCT "Order ID") AS total_orders,
  {money_avg('profit_margin')} AS avg_profit_margin, COUNT(DISTINCT "Customer ID") AS total_customers
FROM wide""")
ORACLE["bi_top_products"] = sql(["wide"], f"""SELECT product_name, sum_sales FROM (
  SELECT "Product Name" AS product_name, {money_sum('"Sales"')} AS sum_sales FROM wide GROUP BY 1
  ORDER BY sum_sales DESC, product_name ASC NULLS FIRST LIMIT 10)""")
ORACLE["bi_top_customers"] = sql(["wide"], f"""SELECT "Customer Name" AS customer_name,
  COUNT("Order ID") AS order_count, {money_sum('"Profit"')} AS sum_profit, {money_sum('"Sales"')} AS sum_sales
FROM wide WHERE "Customer ID" IN (
  SELECT id FROM (SELECT "Customer ID" AS id, {money_avg('"Profit"')} AS a
    FROM wide WHERE "Customer ID" IS NOT NULL GROUP BY 1 ORDER BY a DESC, id ASC LIMIT 10))
GROUP BY 1""")
ORACLE["bi_rows_in_top"] = sql(["wide"], f"""SELECT "Row ID" AS row_id, "Product Name" AS product_name, "Sales" AS sales
FROM wide WHERE "Product Name" IN (
  SELECT p FROM (SELECT "Product Name" AS p, {money_sum('"Sales"')} AS s FROM wide GROUP BY 1 ORDER BY s DESC, p LIMIT 5))""")
ORACLE["bi_customers_by_segment"] = sql(["wide"], """SELECT "Segment" AS segment,
  COUNT(DISTINCT "Customer ID") AS customers FROM wide GROUP BY 1""")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
