"""Cutting lineage with tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.session import work_dir


def saved(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame``, written once as Parquet in the shared folder and read from there.

    Later reads neither recompute it nor depend on an executor that may be lost, and Spark
    knows its size when it plans a join.
    """
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def bucketed(frame: DataFrame, purpose: str, *keys: str, compression: str = "snappy") -> DataFrame:
    """``frame`` written in as many buckets by ``keys`` as there are shuffle partitions.

    Joins and groups by ``keys`` need no shuffle of it. Buckets need a table name; it goes again
    at once, the files (in the shared folder) stay.
    """
    spark = frame.sparkSession
    name, path = f"{purpose}_{uuid.uuid4().hex}", work_dir(spark, purpose)
    writer = frame.write.bucketBy(partitions(spark), *keys).option("path", path).option("compression", compression)
    writer.saveAsTable(name)
    opened = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return opened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions: the unit in which all work here is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(column: str = "text"):
    """Tells apart rows that share a doc_id; equal texts (and NULL and '') agree."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
