"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives the inputs from the same test tables and states each
operator's semantics directly (correlated sub-queries for the as-of
lookups, FILTER counts for the quality rules), so it does not mirror the
Spark plans.  Spark's ``round`` is half-up on the shortest decimal text of
a double; ``rnd`` reproduces that in DuckDB.
"""

from __future__ import annotations

import json

# Every name, rule and constant below is written out here and not taken from the
# engine, so that a wrong one there cannot hide.
LEDGER_TYPES = {
    "Row ID": "bigint", "Order ID": "string", "Order Date": "string", "Ship Date": "string",
    "Ship Mode": "string", "Customer ID": "string", "Customer Name": "string", "Segment": "string",
    "Country": "string", "City": "string", "State": "string", "Postal Code": "bigint",
    "Region": "string", "Product ID": "string", "Category": "string", "Sub-Category": "string",
    "Product Name": "string", "Sales": "double", "Quantity": "int", "Discount": "double",
    "Profit": "double",
}
RAW_LEDGER_COLUMNS = list(LEDGER_TYPES)


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def money_sum(x: str) -> str:
    """Exact decimal sum; by way of text, so that both conversions round correctly."""
    return f"CAST(CAST({exact_sum(x)} AS VARCHAR) AS DOUBLE)"


def exact_sum(x: str) -> str:
    return f"SUM(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)))"


def money_avg(x: str) -> str:
    return f"({money_sum(x)}) / COUNT({x})"


def rolling(window: str) -> str:
    return f"CAST(CAST(SUM(total) OVER {window} AS VARCHAR) AS DOUBLE) / COUNT(total) OVER {window}"


_RULE_ROWS = """(0, 'New Year''s Day', 'National holiday', 'fixed', 1, 1, 0, ''),
    (1, 'Martin Luther King Jr. Day', 'National holiday', 'nth', 1, 2, 3, ''),
    (2, 'Valentine''s Day', 'Observance', 'fixed', 2, 14, 0, ''),
    (3, 'Presidents'' Day', 'National holiday', 'nth', 2, 2, 3, ''),
    (4, 'Tax Day', 'Observance', 'fixed', 4, 15, 0, ''),
    (5, 'Mother''s Day', 'Observance', 'nth', 5, 1, 2, ''),
    (6, 'Memorial Day', 'National holiday', 'last', 5, 2, 0, ''),
    (7, 'Father''s Day', 'Observance', 'nth', 6, 1, 3, 'T00:00:00-04:00'),
    (8, 'Independence Day', 'National holiday', 'fixed', 7, 4, 0, ''),
    (9, 'Labor Day', 'National holiday', 'nth', 9, 2, 1, ''),
    (10, 'Columbus Day', 'National holiday', 'nth', 10, 2, 2, ''),
    (11, 'Halloween', 'Observance', 'fixed', 10, 31, 0, ''),
    (12, 'Veterans Day', 'National holiday', 'fixed', 11, 11, 0, ''),
    (13, 'Thanksgiving Day', 'National holiday', 'nth', 11, 5, 4, ''),
    (14, 'Christmas Eve', 'Observance', 'fixed', 12, 24, 0, ''),
    (15, 'Christmas Day', 'National holiday', 'fixed', 12, 25, 0, ''),
    (16, 'Christmas Day', 'Christian', 'fixed', 12, 25, 0, ''),
    (17, 'Valentine''s Day', 'Observance', 'none', 2, 0, 0, ''),
    (18, 'Mother''s Day', 'Observance', 'fixed', 7, 4, 0, '')"""
_NAMES = """'New Year''s Day', 'Martin Luther King Jr. Day', 'Presidents'' Day', 'Memorial Day',
    'Independence Day', 'Labor Day', 'Columbus Day', 'Veterans Day', 'Thanksgiving Day',
    'Christmas Day', 'Valentine''s Day', 'Mother''s Day', 'Father''s Day'"""

CTES: dict[str, tuple[str, list[str]]] = {
    "cg": ("""SELECT c.c_custkey, 'Customer ' || CAST(c.c_custkey - c.c_custkey % 2 AS VARCHAR) AS c_name,
           c.c_nationkey, c.c_mktsegment, n.n_name, r.r_regionkey,
           CASE r.r_name WHEN 'EUROPE' THEN 'Central' WHEN 'ASIA' THEN 'East' WHEN 'AFRICA' THEN 'South'
                WHEN 'AMERICA' THEN 'West' ELSE r.r_name END AS r_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey""", []),
    "raw": ("""SELECT l.l_orderkey * 10 + l.l_linenumber AS "Row ID",
      'ORD-' || CAST(o.o_orderkey AS VARCHAR) AS "Order ID",
      CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN NULL
           ELSE strftime(CAST(o.o_orderdate AS DATE), '%-m/%-d/%Y') END AS "Order Date",
      strftime(CAST(l.l_shipdate AS DATE), '%-m/%-d/%Y') AS "Ship Date",
      o.o_orderpriority AS "Ship Mode",
      CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL
           ELSE 'CUST-' || CAST(cg.c_custkey AS VARCHAR) END AS "Customer ID",
      cg.c_name AS "Customer Name", cg.c_mktsegment AS "Segment",
      'United States' AS "Country",
      'City ' || CAST(cg.c_nationkey AS VARCHAR) || '-' || CAST(o.o_orderkey % 4 AS VARCHAR) AS "City",
      cg.n_name AS "State",
      CAST(cg.c_nationkey AS BIGINT) * 100 + o.o_orderkey % 4 AS "Postal Code",
      cg.r_name AS "Region",
      'PART-' || CAST(l.l_partkey AS VARCHAR) AS "Product ID",
      p.p_type AS "Category", p.p_brand AS "Sub-Category",
      p.p_name || ', ' || chr(147) || p.p_brand || chr(148) || chr(160) AS "Product Name",
      l.l_extendedprice AS "Sales", CAST(l.l_quantity AS INTEGER) AS "Quantity",
      l.l_discount AS "Discount",
      l.l_extendedprice * (CAST(0.25 AS DOUBLE) - l.l_discount * CAST(3.0 AS DOUBLE)) AS "Profit"
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN cg ON o.o_custkey = cg.c_custkey JOIN part p ON l.l_partkey = p.p_partkey
    JOIN (VALUES (0), (1)) t(copy) ON t.copy = 0 OR l.l_orderkey % 500 = 3""", ["cg"]),
    "clean": ("""SELECT * REPLACE (
      CAST(try_strptime("Order Date", '%m/%d/%Y') AS DATE) AS "Order Date",
      replace(replace(replace(replace("Product Name", ',', ' -'), chr(147), '"'), chr(148), '"'),
              chr(160), ' ') AS "Product Name")
    FROM raw""", ["raw"]),
    "dim": ("""SELECT 'CUST-' || CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
      c_mktsegment AS segment, 'City ' || CAST(c_nationkey AS VARCHAR) || '-0' AS city,
      n_name AS state, r_name AS region
    FROM cg""", ["cg"]),
    "years": ("""SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE o_orderdate IS NOT NULL""", []),
    "hrules": (f"""SELECT * FROM (VALUES
    {_RULE_ROWS}) t(pos, name, ptype, rule, month, a, b, suffix)""", []),
    "hdates": ("""SELECT y.year, r.pos, r.name, r.ptype, r.suffix,
      CASE r.rule
        WHEN 'fixed' THEN make_date(y.year, r.month, r.a)
        WHEN 'nth' THEN make_date(y.year, r.month, 1)
             + CAST(((r.a - (dayofweek(make_date(y.year, r.month, 1)) + 1) + 7) % 7 + (r.b - 1) * 7) AS INTEGER)
        WHEN 'last' THEN last_day(make_date(y.year, r.month, 1))
             - CAST((((dayofweek(last_day(make_date(y.year, r.month, 1))) + 1) - r.a + 7) % 7) AS INTEGER)
      END AS day
    FROM years y CROSS JOIN hrules r""", ["years", "hrules"]),
    "docs_flat": ("""SELECT year, pos, name, strftime(day, '%Y-%m-%d') || suffix AS iso,
      ptype AS primary_type FROM hdates""", ["hdates"]),
    "fd": (f"""SELECT year, pos AS position, name, iso, primary_type FROM (
      SELECT *, row_number() OVER (PARTITION BY name, iso ORDER BY year, pos) AS rn
      FROM docs_flat
      WHERE name IN ({_NAMES}) AND name <> '' AND iso IS NOT NULL AND iso <> '') WHERE rn = 1""",
           ["docs_flat"]),
    "hol": ("""SELECT name AS holiday_name, TRY_CAST(substr(iso, 1, 10) AS DATE) AS holiday_date
    FROM fd""", ["fd"]),
    "wdays": ("""SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS day, cg.r_name, cg.r_regionkey
    FROM orders o JOIN cg ON o.o_custkey = cg.c_custkey WHERE o.o_orderdate IS NOT NULL""", ["cg"]),
    "weather": ("""SELECT r_name AS weather_region, strftime(day, '%Y-%m-%d') AS weather_date,
      CAST((dn * 7 + r_regionkey * 13) % 61 - 20 AS DOUBLE) AS temp_c,
      CAST(greatest((dn * 11 + r_regionkey * 5) % 37 - 10, 0) AS DOUBLE) AS precipitation_mm,
      CAST(CASE WHEN month(day) IN (12, 1, 2) THEN (dn * 3 + r_regionkey) % 8 ELSE 0 END AS DOUBLE)
        AS snowfall_cm,
      CASE WHEN row_number() OVER (PARTITION BY r_name ORDER BY day DESC) <= r_regionkey THEN NULL
           ELSE CAST((dn * 5 + r_regionkey * 7) % 47 AS DOUBLE) END AS wind_speed_kmh
    FROM (SELECT *, CAST(date_diff('day', DATE '1970-01-01', day) AS BIGINT) AS dn FROM wdays)""",
                ["wdays"]),
    "sh": ("""SELECT c.*, h.holiday_name, h.holiday_date FROM clean c
    LEFT JOIN hol h ON c."Order Date" = h.holiday_date""", ["clean", "hol"]),
    "daily": (f"""SELECT "Order Date" AS d, {exact_sum('"Sales"')} AS total
    FROM sh GROUP BY 1""", ["sh"]),
    "regional": (f"""SELECT "Region" AS r, "Order Date" AS d, {exact_sum('"Sales"')} AS total
    FROM sh WHERE "Order Date" IS NOT NULL GROUP BY 1, 2""", ["sh"]),
    "tg": ("""SELECT year(holiday_date) AS y, max(holiday_date) AS tg FROM hol
    WHERE holiday_name = 'Thanksgiving Day' AND holiday_date IS NOT NULL GROUP BY 1""", ["hol"]),
    "dayt": (f"""SELECT d,
      CAST(date_diff('day', d, (SELECT min(holiday_date) FROM hol WHERE holiday_date >= d)) AS INTEGER)
        AS days_until_next_holiday,
      CAST(date_diff('day', (SELECT max(holiday_date) FROM hol WHERE holiday_date <= d), d) AS INTEGER)
        AS days_since_last_holiday,
      CASE WHEN d BETWEEN (SELECT tg FROM tg WHERE tg.y = year(d)) AND make_date(year(d), 12, 25)
           THEN 1 ELSE 0 END AS holiday_shopping_season_flag,
      {rnd(rolling("w7"), 2)} AS rolling_sales_7d,
      {rnd(rolling("w30"), 2)} AS rolling_sales_30d
    FROM (SELECT *, date_diff('day', DATE '1970-01-01', d) AS dn FROM daily WHERE d IS NOT NULL)
    WINDOW w7 AS (ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW),
           w30 AS (ORDER BY dn RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)""", ["daily", "hol", "tg"]),
    "joined": ("""SELECT c.*, dm.customer_name AS db_customer_name, dm.segment AS db_segment,
      dm.city AS db_city, dm.state AS db_state, dm.region AS db_region
    FROM clean c LEFT JOIN dim dm ON c."Customer ID" = dm.customer_id""", ["clean", "dim"]),
    "jhw": ("""SELECT j.*, h.holiday_name, h.holiday_date, w.temp_c, w.precipitation_mm, w.snowfall_cm,
      w.wind_speed_kmh
    FROM joined j LEFT JOIN hol h ON j."Order Date" = h.holiday_date
    LEFT JOIN weather w ON j."Order Date" = TRY_CAST(w.weather_date AS DATE)
         AND coalesce(j.db_region, j."Region") = w.weather_region""", ["joined", "hol", "weather"]),
}

ROW_FEATURES = f"""
      CASE WHEN x.holiday_name IS NOT NULL THEN 1 ELSE 0 END AS holiday_flag,
      CAST(month(x."Order Date") AS INTEGER) AS month,
      CAST(year(x."Order Date") AS INTEGER) AS year,
      CAST(quarter(x."Order Date") AS INTEGER) AS quarter,
      CASE WHEN dayofweek(x."Order Date") IN (0, 6) THEN 1 ELSE 0 END AS weekend_flag,
      {rnd('x."Profit" / NULLIF(x."Sales", 0) * 100', 2)} AS profit_margin,
      CASE WHEN month(x."Order Date") = 7 AND day(x."Order Date") >= 15 THEN 1
           WHEN month(x."Order Date") = 8 THEN 1 ELSE 0 END AS back_to_school_flag,
      t.days_until_next_holiday, t.days_since_last_holiday,
      coalesce(t.holiday_shopping_season_flag, 0) AS holiday_shopping_season_flag,
      t.rolling_sales_7d, t.rolling_sales_30d"""
WEATHER_FLAGS = """
      CASE WHEN x.precipitation_mm > 0 THEN 1 ELSE 0 END AS is_raining,
      CASE WHEN x.snowfall_cm > 0 THEN 1 ELSE 0 END AS is_snowing,
      CASE WHEN x.precipitation_mm > 25.0 OR x.snowfall_cm > 5.0 OR x.wind_speed_kmh > 40.0
           THEN 1 ELSE 0 END AS extreme_weather_flag"""
_LEDGER_NO_DATE = ", ".join(f"x.{q(c)}" for c in RAW_LEDGER_COLUMNS if c != "Order Date")
_DB = "x.db_customer_name, x.db_segment, x.db_city, x.db_state, x.db_region"
_W4 = "x.temp_c, x.precipitation_mm, x.snowfall_cm, x.wind_speed_kmh"
_NULL_W4 = ("CAST(NULL AS DOUBLE) AS temp_c, CAST(NULL AS DOUBLE) AS precipitation_mm, "
            "CAST(NULL AS DOUBLE) AS snowfall_cm, CAST(NULL AS DOUBLE) AS wind_speed_kmh")

CTES["wide"] = (f"""SELECT x."Order Date", {_LEDGER_NO_DATE}, {_DB}, x.holiday_name, x.holiday_date,
      {_W4},{ROW_FEATURES},{WEATHER_FLAGS}
    FROM jhw x LEFT JOIN dayt t ON x."Order Date" = t.d""", ["jhw", "dayt"])
CTES["feat"] = (f"""SELECT x."Order Date", {_LEDGER_NO_DATE}, x.holiday_name, x.holiday_date,
      {ROW_FEATURES}, {_NULL_W4}, 0 AS is_raining, 0 AS is_snowing, 0 AS extreme_weather_flag
    FROM sh x LEFT JOIN dayt t ON x."Order Date" = t.d""", ["sh", "dayt"])


def with_(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n    {CTES[n][0]}\n)" for n in order) + "\n"


def sql(deps: list[str], body: str) -> str:
    return with_(*deps) + body


# ----------------------------------------------------------------- quality oracles
DQ_SELECT = ("dataset, rule_id, expectation_type, \"column\", success, element_count, "
             "unexpected_count, unexpected_percent, observed, error")


def _pct(u: str) -> str:
    return f"CASE WHEN n > 0 THEN {rnd(f'{u} * 100.0 / n', 2)} ELSE 0.0 END"


def dq_count_row(dataset: str, i: int, etype: str, column: str, bad: str) -> str:
    return (f"SELECT {lit(dataset)} AS dataset, CAST({i} AS INTEGER) AS rule_id, {lit(etype)} AS expectation_type, "
            f"{lit(column)} AS \"column\", u{i} = 0 AS success, n AS element_count, u{i} AS unexpected_count, "
            f"{_pct(f'u{i}')} AS unexpected_percent, CAST(NULL AS VARCHAR) AS observed, "
            f"CAST(NULL AS VARCHAR) AS error FROM counts")


def dq_static_row(dataset, i, etype, column, success, observed=None, error=None) -> str:
    return (f"SELECT {lit(dataset)} AS dataset, CAST({i} AS INTEGER) AS rule_id, {lit(etype)} AS expectation_type, "
            f"CAST({lit(column)} AS VARCHAR) AS \"column\", {'TRUE' if success else 'FALSE'} AS success, "
            f"CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS unexpected_count, "
            f"CAST(NULL AS DOUBLE) AS unexpected_percent, CAST({lit(observed)} AS VARCHAR) AS observed, "
            f"CAST({lit(error)} AS VARCHAR) AS error")


def dq_rowcount_row(dataset, i, lo, hi) -> str:
    return (f"SELECT {lit(dataset)} AS dataset, CAST({i} AS INTEGER) AS rule_id, "
            f"'expect_table_row_count_to_be_between' AS expectation_type, CAST(NULL AS VARCHAR) AS \"column\", "
            f"n BETWEEN {lo} AND {hi} AS success, n AS element_count, CAST(NULL AS BIGINT) AS unexpected_count, "
            f"CAST(NULL AS DOUBLE) AS unexpected_percent, CAST(n AS VARCHAR) AS observed, "
            f"CAST(NULL AS VARCHAR) AS error FROM counts")


def columns_observed(cols: list[str], expected: list[str]) -> str:
    return json.dumps({"observed_columns": cols, "missing_columns": sorted(set(expected) - set(cols))})
