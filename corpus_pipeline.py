"""Corpus pipeline: toxicity, near duplicates, benchmark leaks, secrets, packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written
and read again as the next stage's ``docs``, and the stage's intermediate
tables are deleted then.  Column names of the input are set aside while a
stage works, so that extra columns cannot clash with its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import decontaminate, jaccard, packing, secrets, toxicity
from martforge.llm.common import clean, numbered, own_tables, read
from martforge.session import work_path

#: near duplicates: five-word shingles, Jaccard similarity 0.8 (op5's query has its own 4 and 85)
NEAR_SIZE, NEAR_PERCENT = 5, 80


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, and the neutral name of each column."""
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(new).alias(old) for old, new in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    labels = clean(read(spark, sf_dir, "labels"), "doc_id", "toxic")
    model = toxicity.train(clean(docs, "doc_id", "text"), labels)
    rows, names = _aside(docs)
    return _back(toxicity.tag(rows, model, text=names["text"]).where(F.col("score") < toxicity.THRESHOLD), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id.

    Rows count by their texts: rows without id or with the same id stay unless they are
    near duplicates.  A row without id gives way to one that has an id.
    """
    rows, names = _aside(docs)
    rows = numbered(rows, "_row", **{c: c for c in names.values()})
    found = jaccard.row_classes(rows, names["text"], "_row", NEAR_SIZE, NEAR_PERCENT)
    ids = found.join(rows.select("_row", F.col(names["doc_id"]).alias("_doc")), "_row")
    first = F.min(F.struct(F.col("_doc").isNull().alias("none"), "_doc", "_row"))["_row"]
    kept = ids.where(F.col("class").isNotNull()).groupBy("class").agg(first.alias("_row")).select("_row")
    kept = kept.unionByName(ids.where(F.col("class").isNull()).select("_row"))  # no words: near nothing
    return _back(rows.join(kept, "_row", "left_semi"), names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    rows, names = _aside(docs)
    marked = decontaminate.decontaminate(rows, read(spark, sf_dir, "benchmark"), text=names["text"])
    return _back(marked.where(F.col("n_hit") == 0), names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret spans replaced; n_chars follows the text."""
    rows, names = _aside(docs)
    text = names["text"]
    done = secrets.redact(rows, text=text)
    if "n_chars" in names:
        size = names["n_chars"]
        done = done.withColumn(size, F.when(F.size("secret_spans") > 0, F.length(text).cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col(size)))
    return _back(done, names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str, out: str | None = None) -> DataFrame:
    """Pieces of the remaining documents, packed; the sequences are written under ``out``."""
    return packing.report(docs, out)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: tokenization and the learned stage have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again.

    The packed sequences with their token ids, the training data, are written
    under ``out`` (a work path if None); the result lists their pieces.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        with own_tables():
            done = stage(spark, docs, sf_dir, out) if stage is pack else stage(spark, docs, sf_dir)
            done.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
