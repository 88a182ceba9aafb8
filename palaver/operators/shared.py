"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def materialized(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write a frame and read it back: lineage ends here, and a lost executor costs no recomputation.

    The folder is ``spark.checkpoint.dir``; where it is unset, as in tests on one
    machine, one in the warehouse folder.  ``by`` names columns that later reads filter on.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
