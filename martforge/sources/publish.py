"""Tables that are replaced only when their successor is complete.

A publish writes beside the table, checks that the files hold every row, and
then switches: whole folders, or the partition folders that changed, are
renamed into place, and what they replace is kept until the last of them is.
Which renames belong to a switch is noted in one file beforehand; a switch that
was cut off is finished by the next publish or ``read_table``.  A publish that
fails before the note leaves the table as it was.

Renames are single steps on HDFS and local file systems; on stores where they
copy, a switch takes longer but ends the same way.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Folders:
    """Files and folders of the path's file system, through Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        self.fs.mkdirs(self._path(new).getParent())
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def children(self, path: str) -> list[str]:
        """Names of the folders in ``path``, but for hidden ones."""
        found = (s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isDirectory())
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def leaves(self, path: str, depth: int) -> list[str]:
        """Relative paths of the folders ``depth`` levels below ``path``."""
        if not depth:
            return [""]
        return [f"{child}/{rest}".rstrip("/") for child in self.children(path) for rest in self.leaves(f"{path}/{child}", depth - 1)]

    def write(self, path: str, text: str) -> None:
        """A file that is there whole or not at all."""
        part = f"{path}.{uuid.uuid4().hex}"
        out = self.fs.create(self._path(part))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.rename(part, path)

    def text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def _beside(path: str, kind: str, own: str = "") -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{kind}{own}"


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
          metrics: dict | None = None, **options) -> tuple[str, dict]:
    """Write ``df`` to a fresh folder beside ``path`` and check its rows.

    Returns the folder and what was counted while the rows were written: ``rows`` and
    the aggregates in ``metrics`` (name -> column).
    """
    spark = df.sparkSession
    staging = _beside(path, "staging-", uuid.uuid4().hex)
    seen = Observation(f"publish_{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    try:
        writer = counted.write.format(fmt).options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(staging)
        got = dict(seen.get)
        found = spark.read.format(fmt).schema(df.schema).load(staging).count()
        if found != got["rows"]:
            raise RuntimeError(f"{staging}: {got['rows']} rows written, {found} read back")
    except BaseException:
        Folders(spark, path).delete(staging)
        raise
    return staging, got


def switch(spark: SparkSession, staging: str, path: str, parts: list[str] | None = None, gone: tuple = ()) -> None:
    """Put ``staging`` in the place of the table at ``path``: all of it, or only its folders
    ``parts``; folders in ``gone`` are taken away."""
    recover(spark, path)
    note = {"staging": staging, "old": _beside(path, "old-", uuid.uuid4().hex), "parts": [""] if parts is None else parts,
            "gone": list(gone)}
    Folders(spark, path).write(_beside(path, "switch"), json.dumps(note))
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a switch that was begun; whether there was one."""
    folders, noted = Folders(spark, path), _beside(path, "switch")
    if not folders.exists(noted):
        return False
    note = json.loads(folders.text(noted))

    def place(root, part):
        return f"{root}/{part}" if part else root

    for part in note["gone"]:
        if folders.exists(place(path, part)):
            folders.rename(place(path, part), place(note["old"], part))
    for part in note["parts"]:  # a part that is still in staging has not been switched
        if folders.exists(place(note["staging"], part)):
            if folders.exists(place(path, part)):
                folders.rename(place(path, part), place(note["old"], part))
            folders.rename(place(note["staging"], part), place(path, part))
    folders.delete(noted)
    folders.delete(note["old"])
    folders.delete(note["staging"])
    return True


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet", keep_others: bool = False,
            metrics: dict | None = None, **options) -> dict:
    """Put ``df`` in the place of the table at ``path``; ``keep_others`` leaves the partitions
    that ``df`` has no rows of.  Returns what ``stage`` counted."""
    spark = df.sparkSession
    recover(spark, path)
    staging, counted = stage(df, path, partition_by, fmt, metrics, **options)
    folders = Folders(spark, path)
    if keep_others and partition_by and folders.exists(path):
        switch(spark, staging, path, folders.leaves(staging, len(partition_by)))
    else:
        switch(spark, staging, path)
    return counted


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` as its last complete publish left it."""
    recover(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def missing(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "").startswith("PATH_NOT_FOUND")
