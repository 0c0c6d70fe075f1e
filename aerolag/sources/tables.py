"""Readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def use_access_token(spark: SparkSession, container: str, host: str, token: str) -> None:
    """Let the session read an object store container by access token.

    Names and the token come from the caller, never from code.
    """
    spark.conf.set(f"fs.azure.sas.{container}.{host}", token)


def _checked(df: DataFrame, schema: T.StructType | None, where: str) -> DataFrame:
    if schema is None:
        return df
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{where} does not match its schema: {'; '.join(wrong)}")
    return df.select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. With a schema, names and types are checked and only its
    columns are kept, so that the scan reads nothing else."""
    return _checked(spark.read.parquet(path), schema, path)


def read_many(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Several parquet folders of one layout as a single scan."""
    return _checked(spark.read.parquet(*paths), schema, ", ".join(paths))


def records_table(spark: SparkSession, records: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A few driver-side records, such as search trials, as a table."""
    rows = [tuple(r.get(name) for name in schema.fieldNames()) for r in records]
    return spark.createDataFrame(rows, schema)


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """Files under a folder with size and time, without reading their content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Parquet write; fails if the target exists unless told to overwrite."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)
