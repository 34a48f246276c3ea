"""Reading the test tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.stages import store_stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read
    back: later jobs reread files, whichever executors are lost meanwhile. The
    table belongs to the ledger around it (:mod:`panelkit.stages`)."""
    return store_stage(df, label)
