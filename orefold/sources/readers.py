"""Raw CSV files and catalog tables as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sinks import read_commit, resolve


def read_csv_strings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headered CSV; column names come from the header, all values are strings.

    A file whose header differs from the first file's is an error rather than
    silently shifted columns, and so is a row with more or fewer fields.
    """
    return _strict(spark).option("inferSchema", False).csv(path)


def read_csv_declared(
    spark: SparkSession, path: str | list[str], columns: Sequence[str]
) -> DataFrame:
    """Headered CSV with declared string columns.

    A different header is an error, and so is a row with more or fewer fields.
    """
    return _strict(spark).schema(_strings(columns)).csv(path)


def read_csv_flagged(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], flag: str = "_malformed"
) -> DataFrame:
    """As `read_csv_declared`, but rows with more or fewer fields stay.

    Their text is in the column `flag`, which is null for whole rows.
    """
    return (
        spark.read.schema(_strings([*columns, flag]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", flag)
        .option("columnPruning", False)
        .csv(path)
    )


def count_malformed(df: DataFrame, flag: str = "_malformed") -> DataFrame:
    """One row: all rows of a flagged scan, and those with a wrong number of fields."""
    # A scan must read some column beside the flag.
    first = next(c for c in df.columns if c != flag)
    malformed = F.col(flag).isNotNull() & (F.coalesce(F.length(first), F.lit(0)) >= 0)
    return df.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(malformed).alias("rows_malformed"))


def _strings(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in columns])


def _strict(spark: SparkSession) -> DataFrameReader:
    # The parser counts fields only in rows that it splits whole, so the
    # columns of a scan are dropped after parsing.
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or published name of one to three parts.

    A published name is read through the commit record of its layer.
    """
    return spark.table(resolve(spark, name))


def read_layer(spark: SparkSession, layer: str, tables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Published tables of a layer as one commit left them, by name.

    The record is read once, so all frames belong together, whatever is
    committed later.
    """
    record = read_commit(spark, layer)
    return {table: spark.table(resolve(spark, f"{layer}.{table}", record)) for table in tables or record}
