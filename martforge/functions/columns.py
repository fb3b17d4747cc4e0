"""Column-set operators (P1, P5, P6, P7, P10): metadata only, no job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalized_name(name: str) -> str:
    """trim -> lower -> ' ' to '_' -> '-' to '_'  ("Sub-Category" -> sub_category)."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [normalized_name(c) for c in df.columns]
    seen = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both normalize to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def add_missing_columns(df: DataFrame, names: list[str], data_type=T.DoubleType()) -> DataFrame:
    """Append each absent column as a typed NULL, in the order given."""
    missing = {n: F.lit(None).cast(data_type) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


# Marks of packed texts: the end of one, and what an escape begins with.
_END, _MARK = "\u0001", "\u0002"


def pack_texts(columns: list[str]) -> Column:
    """The texts of ``columns`` as one text, for an exchange: in a row each text has a word for its place
    and length, which differ from row to row and compress badly.  Any text is kept as it is, NULL too
    (``unpack_texts``)."""
    def packed(c: Column) -> Column:
        plain = F.replace(F.replace(c, F.lit(_MARK), F.lit(_MARK + "m")), F.lit(_END), F.lit(_MARK + "e"))
        return (F.when(c.isNull(), _MARK + "n").when(F.is_valid_utf8(c), plain)
                .otherwise(F.concat(F.lit(_MARK + "x"), F.hex(c.cast("binary")))))

    return F.concat_ws(_END, *[packed(F.col(f"`{c}`")) for c in columns])


def unpack_texts(df: DataFrame, packed: str, columns: list[str]) -> DataFrame:
    """``df`` with the texts of ``pack_texts(columns)`` as columns instead of ``packed``."""
    def text(c: Column) -> Column:
        plain = F.replace(F.replace(c, F.lit(_MARK + "e"), F.lit(_END)), F.lit(_MARK + "m"), F.lit(_MARK))
        return (F.when(~c.contains(_MARK), c).when(c == _MARK + "n", None)
                .when(c.startswith(_MARK + "x"), F.unhex(F.substring(c, 3, 2 ** 31 - 1)).cast("string")).otherwise(plain))

    # one expression for all of them: generated code of a row stays small enough to be compiled
    parts = df.withColumn("__texts", F.transform(F.split(packed, _END), text))
    return parts.withColumns({c: F.col("__texts")[i] for i, c in enumerate(columns)}).drop("__texts", packed)


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) rows describing df."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")
