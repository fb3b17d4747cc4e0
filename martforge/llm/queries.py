"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, idfiles, jaccard, langid, packing, prefixtrie, quality, secrets, shards, spelling, substrings,
               toxicity, warc)
from .common import read


def _documents(report) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report(read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substrings": _documents(substrings.report),
        "op2_warc": warc.report,
        "op3_decontaminate": op3_decontaminate,
        "op4_shards": _documents(shards.report),
        "op5_jaccard": _documents(jaccard.report),
        "op6_packing": _documents(packing.report),
        "op7_langid": _documents(langid.report),
        "op8_secrets": _documents(secrets.report),
        "op9_quality": _documents(quality.report),
        "op10_toxicity": op10_toxicity,
        "op11_spelling": _documents(spelling.report),
        "op12_prefixtrie": prefixtrie.report,
        "op13_idfiles": _documents(idfiles.report),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substrings": substrings.ORACLE_SQL,
        "op2_warc": warc.ORACLE_SQL,
        "op3_decontaminate": decontaminate.ORACLE_SQL,
        "op5_jaccard": jaccard.ORACLE_SQL,
        "op9_quality": quality.ORACLE_SQL,
        "op11_spelling": spelling.ORACLE_SQL,
        "op12_prefixtrie": prefixtrie.ORACLE_SQL,
    }
