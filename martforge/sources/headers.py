"""CSV parts read by the names in their headers.

Part files of one extract may list their columns in another order or lack
some.  The first record of every file is read on the driver (one short line a
file, like the listing of the files itself), files of equal headers are one
scan, and the scans are put together by name.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPENED_AT_ONCE = 32  # files whose headers are read at the same time


def header_of(spark: SparkSession, file: str, encoding: str) -> tuple[str, ...] | None:
    """Column names of one file (compressed files too); None if it is empty."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, encoding))
        record = reader.readLine()
        while record is not None and record.count('"') % 2:  # a line break inside a quoted name
            more = reader.readLine()
            if more is None:
                break
            record += "\n" + more
    finally:
        stream.close()
    if record is None:
        return None
    names = next(csv.reader(io.StringIO(record.removeprefix("﻿"))), [])
    return tuple(name or f"_c{i}" for i, name in enumerate(names))


def header_groups(spark: SparkSession, path: str | list[str], encoding: str) -> dict[tuple[str, ...], list[str]]:
    """Files under ``path`` (file, folder, glob or list) by their header; empty files are left out."""
    files = [unquote(f) for f in spark.read.format("text").load(path).inputFiles()]
    with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
        headers = pool.map(lambda f: header_of(spark, f, encoding), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header:
            groups.setdefault(header, []).append(file)
    for header, members in groups.items():
        if len(set(header)) < len(header):
            raise ValueError(f"{members[0]}: a column name occurs twice in {list(header)}")
    return groups


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrower of the types that hold the values of both; text if no other does."""
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    numbers = [*whole, T.FloatType(), T.DoubleType()]
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in numbers and b in numbers:
        wide = max(a, b, key=numbers.index)
        return wide if a in whole and b in whole or wide == T.DoubleType() else T.DoubleType()
    days = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]
    if a in days and b in days and T.DateType() in (a, b):
        return max(a, b, key=days.index)
    return T.StringType()


def align(parts: list[DataFrame]) -> DataFrame:
    """Union by name: columns in the order in which they first appear, absent ones NULL, a type
    that holds the values of all parts."""
    types: dict[str, T.DataType] = {}
    for part in parts:
        for f in part.schema.fields:
            types[f.name] = _wider(types[f.name], f.dataType) if f.name in types else f.dataType

    def shaped(part):
        have = set(part.columns)
        return part.select(*[(F.col(f"`{n}`").cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in types.items()])

    return reduce(DataFrame.unionByName, [shaped(p) for p in parts])
