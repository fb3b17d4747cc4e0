"""Declarative data-quality rules, compiled into one aggregate pass (Q1-Q10, T5).

A rule list is evaluated per dataset with ONE ``agg`` (a row count plus one
``count_if`` per value rule); schema rules (columns, types) read metadata
only.  Sample failing values are fetched only for rules that failed, all in
one scan, of which each partition forwards its first 10 per rule.  A rule that
cannot be evaluated is one failed row with its error; the others keep theirs.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import to_timestamp_tolerant

RESULT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("expectation_type", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("kwargs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("success", T.BooleanType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("unexpected_values", T.ArrayType(T.StringType())),
    T.StructField("observed", T.StringType()),
    T.StructField("error", T.StringType()),
])
SAMPLE_SIZE = 10


@dataclass(frozen=True)
class Rule:
    expectation_type: str
    kind: str
    column: str | None = None
    params: tuple = ()
    kwargs: dict = field(default_factory=dict, compare=False, hash=False)


def _kw(**kv) -> dict:
    return {k: v if isinstance(v, str) else json.dumps(v) for k, v in kv.items()}


def columns_match(expected: list[str], ordered: bool = False) -> Rule:
    return Rule("expect_table_columns_to_match_set", "columns", None, (tuple(expected), ordered),
                _kw(expected_columns=list(expected), ordered=ordered))


def column_exists(column: str) -> Rule:
    return Rule("expect_column_to_exist", "exists", column, (), _kw(column=column))


def not_null(column: str) -> Rule:
    return Rule("expect_column_values_to_not_be_null", "not_null", column, (), _kw(column=column))


def of_type(column: str, expected_type: str) -> Rule:
    return Rule("expect_column_values_to_be_of_type", "type", column, (expected_type,),
                _kw(column=column, expected_type=expected_type))


def between(column: str, min_val, max_val, parse_date: bool = False) -> Rule:
    return Rule("expect_column_values_to_be_between", "between", column,
                (min_val, max_val, parse_date),
                _kw(column=column, min_val=str(min_val), max_val=str(max_val)))


def in_set(column: str, allowed: list) -> Rule:
    return Rule("expect_column_values_to_be_in_set", "in_set", column, (tuple(allowed),),
                _kw(column=column, allowed_set=list(allowed)))


def gte(column: str, value) -> Rule:
    return Rule("expect_column_values_to_be_greater_than_or_equal_to", "gte", column, (value,),
                _kw(column=column, value=value))


def row_count_between(min_rows: int, max_rows: int) -> Rule:
    return Rule("expect_table_row_count_to_be_between", "row_count", None, (min_rows, max_rows),
                _kw(min_rows=min_rows, max_rows=max_rows))


# pandas dtype families mapped onto Spark types
_TYPE_FAMILIES = {
    "numeric": (T.NumericType, T.BooleanType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType, T.VarcharType, T.CharType, T.ArrayType, T.MapType, T.StructType),
    "object": (T.StringType, T.VarcharType, T.CharType, T.ArrayType, T.MapType, T.StructType),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def _value(df: DataFrame, column: str) -> Column:
    """Column value with float NaN treated as missing (pandas semantics)."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def _number(v: Column, data_type: T.DataType, bound) -> Column:
    """The value compared with a numeric bound; text counts by the number it holds."""
    if isinstance(data_type, T.StringType) and not isinstance(bound, str):
        return v.try_cast("double")
    return v


def _bad(df: DataFrame, rule: Rule) -> tuple[Column, Column] | None:
    """(unexpected predicate, value shown in samples) for a value rule.

    Text that holds no number cannot satisfy a numeric bound: it is unexpected.
    """
    v = _value(df, rule.column)
    data_type = df.schema[rule.column].dataType
    if rule.kind == "not_null":
        blank = (v == "") if isinstance(data_type, T.StringType) else F.lit(False)
        return v.isNull() | blank, F.lit(None).cast("string")
    if rule.kind == "between":
        lo, hi, parse_date = rule.params
        if parse_date:
            ts = to_timestamp_tolerant(v, data_type)
            lo_c, hi_c = F.lit(str(lo)).cast("timestamp"), F.lit(str(hi)).cast("timestamp")
            return ts.isNotNull() & ((ts < lo_c) | (ts > hi_c)), ts.cast("string")
        x = _number(v, data_type, lo)
        return v.isNotNull() & F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(True)), v.cast("string")
    if rule.kind == "in_set":
        (allowed,) = rule.params
        return v.isNotNull() & ~v.isin(list(allowed)), v.cast("string")
    if rule.kind == "gte":
        (value,) = rule.params
        x = _number(v, data_type, value)
        return v.isNotNull() & F.coalesce(x < F.lit(value), F.lit(True)), v.cast("string")
    return None


def _static(df: DataFrame, rule: Rule) -> tuple[bool, str | None, str | None]:
    """(success, observed, error) of a schema-only rule."""
    cols = df.columns
    if rule.kind == "columns":
        expected, ordered = rule.params
        ok = list(expected) == cols if ordered else set(expected) <= set(cols)
        missing = sorted(set(expected) - set(cols))
        return ok, json.dumps({"observed_columns": cols, "missing_columns": missing}), None
    if rule.kind == "exists":
        return rule.column in cols, json.dumps(cols), None
    if rule.column is not None and rule.column not in cols:
        return False, None, "Column not found"
    if rule.kind == "type":
        (expected_type,) = rule.params
        dt = df.schema[rule.column].dataType
        family = _TYPE_FAMILIES.get(expected_type)
        return (family is not None and isinstance(dt, family)), dt.simpleString(), None
    return True, None, None


def _counted(df: DataFrame, bad: dict[int, tuple]) -> tuple[int | None, dict[int, int], dict[int, str]]:
    """(rows, unexpected rows by rule, errors by rule): one aggregate; if that
    fails, one per rule, so that a rule that cannot run is told from the others."""
    def run(part):
        got = df.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(pred).alias(f"__u{i}") for i, (pred, _) in part.items()]).first()
        return int(got["__n"]), {i: int(got[f"__u{i}"]) for i in part}

    try:
        rows, counts = run(bad)
        return rows, counts, {}
    except PySparkException:
        rows, _ = run({})  # an error here is the dataset's, not a rule's
    counts, errors = {}, {}
    for i, pair in bad.items():
        try:
            counts.update(run({i: pair})[1])
        except PySparkException as exc:
            errors[i] = f"{type(exc).__name__}: {exc}"
    return rows, counts, errors


#: writes a table, counting metrics meanwhile: (df, {name: column}) -> (table read back, counts with ``rows``)
Writer = Callable[[DataFrame, dict[str, Column]], tuple[DataFrame, dict]]


def _counted_in_write(df: DataFrame, bad: dict[int, tuple], write: Writer) -> tuple:
    """The written table and the counts of ``_counted``, taken while it was written."""
    try:
        table, got = write(df, {f"__u{i}": F.count_if(pred) for i, (pred, _) in bad.items()})
    except PySparkException:  # a rule that cannot run must not stop the table
        table, _ = write(df, {})
        return table, _counted(table, bad)
    return table, (int(got["rows"]), {i: int(got[f"__u{i}"]) for i in bad}, {})


def rule_columns(df: DataFrame, rules: list[Rule], order: list[str] | None = None) -> DataFrame:
    """``df`` with the columns that value rules and their samples read."""
    wanted = {r.column for r in rules} | set(order or [])
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted])


def validate(df: DataFrame, rules: list[Rule], dataset: str,
             sample_order: list[str] | None = None, samples: bool = True, write: Writer | None = None) -> DataFrame:
    """One result row per rule (schema ``RESULT_SCHEMA``).

    The counts come from ONE aggregate action over ``df`` (a single row of
    ``#rules`` numbers reaches the driver, never data rows); a list of schema
    rules alone reads nothing.  Failing values are then fetched for the value
    rules that failed, in one more scan.

    With ``write``, ``df`` runs once: the counts are taken while the table is
    written (published, or a copy), and the failing values come from the table.
    """
    plans, bad = [], {}
    for i, rule in enumerate(rules):
        ok, observed, error = _static(df, rule)
        if not error and rule.kind not in ("columns", "exists", "type", "row_count"):
            try:
                bad[i] = _bad(df, rule)
                df.select(bad[i][0], bad[i][1])  # types are checked here
            except PySparkException as exc:
                bad.pop(i, None)
                ok, error = False, f"{type(exc).__name__}: {exc}"
        plans.append((i, rule, ok, observed, error))
    n, counts, errors = None, {}, {}
    if write is not None:
        df, (n, counts, errors) = _counted_in_write(df, bad, write)
    elif bad or any(rule.kind == "row_count" for rule in rules):
        n, counts, errors = _counted(df, bad)
    rows, sample_specs = [], []
    for i, rule, ok, observed, error in plans:
        head = (dataset, i, rule.expectation_type, rule.column, dict(rule.kwargs))
        if i in counts:
            u = counts[i]
            pct = _round_half_up(u * 100.0 / n, 2) if n > 0 else 0.0
            rows.append(head + (u == 0, n, u, pct, [], None, None))
            if u > 0 and rule.kind != "not_null":
                sample_specs.append((i, bad[i]))
        elif i in errors:
            rows.append(head + (False, None, None, None, None, None, errors[i]))
        elif rule.kind == "row_count" and not error:
            lo, hi = rule.params
            rows.append(head + (lo <= n <= hi, n, None, None, None, str(n), None))
        else:
            rows.append(head + (ok, None, None, None, None, observed, error))
    if samples and sample_specs:
        # at most SAMPLE_SIZE values per failed rule reach the driver
        found = {r["rule_id"]: list(r["__samples"])
                 for r in sample_values(df, sample_specs, sample_order).collect()}
        rows = [row[:9] + (found.get(row[1], row[9]),) + row[10:] for row in rows]
    return df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def _round_half_up(x: float, digits: int) -> float:
    """Spark's ``round`` on a double: half-up on its shortest decimal text."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def sample_values(df: DataFrame, specs: list[tuple[int, tuple[Column, Column]]],
                  order: list[str] | None = None, k: int = SAMPLE_SIZE) -> DataFrame:
    """(rule_id, __samples): up to ``k`` failing values for each listed rule
    (a rule without failing rows gets no row).

    One scan: each row yields an entry per rule it fails, and a rank per rule
    keeps the first ``k``; the rank limit is applied in each partition before
    the exchange.
    """
    keys = [F.col(f"`{c}`").alias(f"k{j}") for j, c in enumerate(order or [])]
    entries = F.array(*[F.when(pred, F.struct(F.lit(i).alias("rule_id"), shown.alias("__v"))) for i, (pred, shown) in specs])
    failed = df.select(*keys, F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"))
    flat = failed.select(*[F.col(f"k{j}") for j in range(len(keys))], "e.rule_id", "e.__v")
    ranked = [F.col(f"k{j}").asc_nulls_first() for j in range(len(keys))] + [F.col("__v").asc_nulls_first()]
    place = F.row_number().over(Window.partitionBy("rule_id").orderBy(*ranked))
    first = flat.withColumn("__place", place).where(F.col("__place") <= k)
    return first.groupBy("rule_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__place", "__v"))), lambda x: x["__v"])
        .alias("__samples"))


def not_in_table(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str) -> DataFrame:
    """Q6 against a table of any size: (element_count, unexpected_count) of the
    non-missing values that ``allowed`` does not hold.  Values are counted
    first, so the anti join moves one row per distinct value and task."""
    v = _value(df, column)
    values = df.groupBy(v.alias("__v")).agg(F.count(F.lit(1)).alias("n"))
    known = allowed.select(F.col(f"`{allowed_column}`").alias("__v")).where("__v is not null").distinct().withColumn("__hit", F.lit(1))
    joined = values.join(known, "__v", "left")
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum(F.when(F.col("__v").isNotNull() & F.col("__hit").isNull(), F.col("n"))), F.lit(0))
        .alias("unexpected_count"))


def summary(results: DataFrame) -> DataFrame:
    """total / passed / failed / pass % (1 decimal) / status over all rule rows."""
    agg = results.agg(F.count(F.lit(1)).alias("total_checks"),
                      F.count_if(F.col("success")).alias("passed_checks"))
    pct = F.when(F.col("total_checks") > 0,
                 F.round(F.col("passed_checks") * 100.0 / F.col("total_checks"), 1)).otherwise(0.0)
    return agg.select(
        "total_checks", "passed_checks",
        (F.col("total_checks") - F.col("passed_checks")).alias("failed_checks"),
        pct.alias("pass_percent"),
        F.when(pct >= 90.0, "Healthy").when(pct >= 75.0, "Warning").otherwise("Unhealthy")
        .alias("status"))
