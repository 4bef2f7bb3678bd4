"""Files that leave the jobs. Every write goes to a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch.sources.stage import stage

# quotes are doubled, blanks kept; an empty text and a null both read back as null
_CSV = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
        "nullValue": "", "lineSep": "\n"}


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), rows_per_file: int = 1_000_000, compression: str = "none") -> str:
    """UTF-8 CSV with header; refuses to overwrite.

    Texts may hold quotes and line breaks. A reader cannot split such files, so
    they are kept to ``rows_per_file``. Long exports repeat the texts of a series
    in every row; ``compression`` (such as gzip) takes these out of the files.
    """
    df.write.options(**_CSV, maxRecordsPerFile=rows_per_file, compression=compression).partitionBy(*partition_by).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    options = {k: v for k, v in _CSV.items() if k != "lineSep"}
    return spark.read.schema(schema).options(**options, multiLine=True).csv(path)


def write_documents(df: DataFrame, path: str) -> str:
    """Nested documents as JSON lines; no rows give an empty folder."""
    df.write.json(path)
    return path


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


class BadRecordsError(RuntimeError):
    """A file holds more records that cannot be read than is allowed."""


def read_checked(spark: SparkSession, path: str, fmt: str, schema: T.StructType, most_bad: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV or JSON file: rejects has a column ``record`` with every line that does not fit the schema.

    Such a line would read as nulls and pass unnoticed. The file is read once, into a staged table. More rejects than the share
    ``most_bad`` of all records raise an error that shows a few.
    """
    options = {"csv": {**{k: v for k, v in _CSV.items() if k != "lineSep"}, "multiLine": True}, "json": {}}[fmt]
    named = T.StructType([*schema.fields, T.StructField("_record", T.StringType())])
    reader = spark.read.schema(named).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_record")
    read = stage(reader.format(fmt).load(path), "checked")
    bad = read.where("_record IS NOT NULL").select(F.col("_record").alias("record"))
    n, total = bad.count(), read.count()
    if n > most_bad * total:
        shown = "; ".join(r["record"][:80] for r in bad.limit(3).collect())
        raise BadRecordsError(f"{n} of {total} records of {path} cannot be read, such as: {shown}")
    return read.where("_record IS NULL").drop("_record"), bad
