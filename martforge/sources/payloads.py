"""API payloads kept as text: the good ones typed, the bad ones counted.

A payload is one JSON document; each is parsed on its own, so one that is
damaged or has another shape costs its own rows and no others.  ``report`` says
which were left out, why, and how many entries of accepted ones were skipped.
Characters behind the first JSON value of a payload are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import WEATHER_METRICS

NO_TEXT, NOT_JSON, NO_ENTRIES = "no text", "not JSON", "no entries"


def read_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source (file), payload (its whole text): one row per file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload"))


def _first(v: Column, *paths: str) -> Column:
    """The array at the first of the paths that holds one."""
    return F.coalesce(*[F.try_variant_get(v, p, "array<variant>") for p in paths])


def _text(v: Column, path: str) -> Column:
    """Text at a path; NULL where something else stands there."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(v, path, "string"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _judged(payloads: DataFrame, payload: str, entries) -> DataFrame:
    """``payloads`` with ``__v`` (parsed), ``__e`` (its entries) and ``reason`` (NULL if it is good)."""
    parsed = payloads.withColumn("__v", F.try_parse_json(payload)).withColumn("__e", entries(F.col("__v")))
    blank = F.col(payload).isNull() | (F.trim(payload) == "")
    return parsed.withColumn("reason", F.when(blank, NO_TEXT).when(F.col("__v").isNull(), NOT_JSON).when(F.col("__e").isNull(), NO_ENTRIES))


def holiday_documents(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``payloads`` without their text, with ``holidays`` (typed records; NULL if the payload is bad),
    ``reason`` and ``skipped`` (entries that are no records).  Records stand under ``holidays`` or
    ``response.holidays``; a field of another type is NULL."""
    judged = _judged(payloads, payload, lambda v: _first(v, "$.response.holidays", "$.holidays"))
    records = F.filter("__e", _is_object)
    typed = F.transform(records, lambda r: F.struct(
        _text(r, "$.name").alias("name"), F.struct(_text(r, "$.date.iso").alias("iso")).alias("date"),
        _text(r, "$.primary_type").alias("primary_type")))
    return (judged.withColumn("holidays", typed)
            .withColumn("skipped", F.when(F.col("__e").isNotNull(), F.size("__e") - F.size("holidays")).otherwise(0))
            .drop(payload, "__v", "__e"))


def weather_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``payloads`` with their text typed as ``payload.daily`` (NULL if it is bad), ``reason`` and ``skipped``
    (metric values that are no numbers; NULL in the series)."""
    judged = _judged(payloads, payload, lambda v: F.try_variant_get(v, "$.daily.time", "array<variant>"))

    def series(metric):
        return F.try_variant_get("__v", f"$.daily.{metric}", "array<variant>")

    def numbers(metric):
        return F.transform(series(metric), lambda x: F.try_variant_get(x, "$", "double"))

    def bad(metric):
        odd = F.filter(series(metric), lambda x: x.isNotNull() & (F.schema_of_variant(x) != "VOID") & F.try_variant_get(x, "$", "double").isNull())
        return F.coalesce(F.size(odd), F.lit(0))

    daily = F.struct(F.transform("__e", lambda t: _text(t, "$")).alias("time"), *[numbers(m).alias(m) for m in WEATHER_METRICS])
    good = F.when(F.col("reason").isNull(), F.struct(daily.alias("daily")))
    skipped = F.when(F.col("reason").isNull(), sum((F.when(series(m).isNull(), 0).otherwise(bad(m)) for m in WEATHER_METRICS), F.lit(0))).otherwise(0)
    return judged.withColumns({"skipped": skipped, payload: good}).drop("__v", "__e")


def accepted(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("reason").isNull()).drop("reason", "skipped")


def report(documents: DataFrame, source: str = "source") -> DataFrame:
    """source, reason (NULL: accepted) and skipped of every payload that was not taken whole."""
    return documents.where(F.col("reason").isNotNull() | (F.col("skipped") > 0)).select(
        F.col(source).alias("source"), "reason", F.col("skipped").cast("long").alias("skipped"))
