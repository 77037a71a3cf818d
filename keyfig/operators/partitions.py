"""Parquet tables whose partitions are replaced one by one, each change behind one commit.

A change is a folder ``<base>/_version=N`` with the new content of the partitions that it
touches, and counts once its ``_SUCCESS`` marker exists.  The content of a partition is that of
the highest committed version that holds it; a partition emptied by a change is an empty folder
there.  Nothing that is being read is ever overwritten: a job that dies leaves a folder without a
marker, which readers pass over and the retry replaces.  (One writer per table is assumed.)

Partition values are read with the type that the caller's schema gives them; none is inferred
from folder names, so ``01`` and ``1``, or ``2023`` and ``2024Q1``, stay what they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyfig.operators.incremental import VERSION, committed_versions
from keyfig.operators.reshape import latest_by
from keyfig.sources.sink import delete_path, list_dir, make_dir


def _folder(spark: SparkSession, column: str, value) -> str:
    """The folder name that Spark's writer gives a partition value."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else utils.escapePathName(str(value))
    return f"{column}={text}"


def layout(spark: SparkSession, base: str, column: str) -> dict[str, str]:
    """Folder of the current content per partition; a listing, no data is read."""
    out: dict[str, str] = {}
    for v in committed_versions(spark, base):  # ascending: later ones win
        for name in list_dir(spark, f"{base}/{VERSION}={v}"):
            if name.startswith(f"{column}="):
                out[name] = f"{base}/{VERSION}={v}/{name}"
    return out


def read(spark: SparkSession, base: str, schema: T.StructType, column: str, values: list | None = None) -> DataFrame:
    """The table, or its partitions of the given values; an empty frame if there are none."""
    now = layout(spark, base, column)
    if values is not None:
        wanted = {_folder(spark, column, v) for v in values}
        now = {k: path for k, path in now.items() if k in wanted}
    if not now:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", base).parquet(*sorted(now.values()))
            .select(*[f"`{f.name}`" for f in schema.fields]))


def replace(df: DataFrame, base: str, column: str, values: list) -> None:
    """The partitions of ``values`` become the rows of ``df`` (which has no others)."""
    spark = df.sparkSession
    path = f"{base}/{VERSION}={(committed_versions(spark, base) or [0])[-1] + 1}"
    delete_path(spark, path)  # an attempt that never was committed
    for v in values:
        make_dir(spark, f"{path}/{_folder(spark, column, v)}")
    # REBALANCE: AQE groups a partition's rows into few files and splits a hot partition
    df.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def values_of(df: DataFrame, column: str) -> list:
    """The partition values in ``df`` (as many as folders that a write of it makes)."""
    return [r[0] for r in df.select(column).distinct().collect()]


def merge_latest(spark: SparkSession, base: str, batch: DataFrame, keys: list[str], order: list[str], column: str) -> None:
    """Latest-wins merge of a batch into the partitions it touches; replays change nothing."""
    touched = values_of(batch, column)
    if touched:
        current = read(spark, base, batch.schema, column, touched)
        replace(latest_by(current.unionByName(batch), keys, order), base, column, touched)
