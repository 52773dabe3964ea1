"""Audit columns: where a row came from and when a layer was built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the audit columns a Bronze table carries.
BRONZE_AUDIT = ("_ingestion_timestamp", "_source_file", "_source_layer")


def with_bronze_audit(
    df: DataFrame, source_file: str | None = None, source_layer: str = "raw"
) -> DataFrame:
    """Add load time, source file and source layer.

    Without `source_file` each row keeps the source file it has, as a stored
    Bronze table does, or else gets the path of the file it was read from; `df`
    must then be a direct file scan.
    """
    if source_file is not None:
        file_name = F.lit(source_file)
    elif "_source_file" in df.columns:
        file_name = F.col("_source_file")
    else:
        file_name = F.col("_metadata.file_path")
    return df.withColumns(
        {
            "_ingestion_timestamp": F.current_timestamp(),
            "_source_file": file_name,
            "_source_layer": F.lit(source_layer),
        }
    )


def drop_bronze_audit(df: DataFrame) -> DataFrame:
    return df.drop(*BRONZE_AUDIT)


def with_silver_audit(df: DataFrame, version: str = "1.0") -> DataFrame:
    return df.withColumns(
        {"_silver_timestamp": F.current_timestamp(), "_silver_version": F.lit(version)}
    )


def with_gold_audit(df: DataFrame) -> DataFrame:
    return df.withColumn("_gold_timestamp", F.current_timestamp())
