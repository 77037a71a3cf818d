"""Incremental maintenance (I1-I6) on plain Parquet.

A table is a folder of immutable versions ``<base>/_version=N``.  Publishing writes version
N+1 next to N and never touches a path that is being read; readers take the highest version,
which Spark's partition discovery turns into a pruned scan.  No table format is required.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfig.operators.joins import anti_join, join_dimension

VERSION = "_version"


# ------------------------------------------------------------------- versioned Parquet tables

def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, from a directory listing (no data or footer is read, so the cost
    does not grow with the table).  A version counts once its ``_SUCCESS`` marker exists."""
    from keyfig.sources.sink import list_dir, path_exists
    if not path_exists(spark, base):
        return []
    out = []
    for name in list_dir(spark, base):
        if name.startswith(f"{VERSION}=") and path_exists(spark, f"{base}/{name}/_SUCCESS"):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def current_version(spark: SparkSession, base: str) -> int | None:
    v = committed_versions(spark, base)
    return v[-1] if v else None


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    v = current_version(spark, base)
    if v is None:
        return None
    return spark.read.parquet(f"{base}/{VERSION}={v}")


def publish(df: DataFrame, base: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as the next version and return it read back from storage (lineage cut).

    Readers only see versions with a ``_SUCCESS`` marker, so a version folder left behind by a
    job that died mid-write is an uncommitted attempt: the retry simply overwrites it.  (One
    writer per table is assumed, as for any Parquet folder without a table format.)"""
    spark = df.sparkSession
    nxt = (current_version(spark, base) or 0) + 1
    path = f"{base}/{VERSION}={nxt}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def retire(spark: SparkSession, base: str, keep: int) -> int:
    """Deletes all but the ``keep`` newest committed versions; returns how many."""
    from keyfig.sources.sink import delete_path
    old = committed_versions(spark, base)[:-keep]
    for v in old:
        delete_path(spark, f"{base}/{VERSION}={v}")
    return len(old)


# ------------------------------------------------------------------- I1 watermark

def watermark(target: DataFrame | None, column: str = "_loaded_at"):
    """The target's high-water mark; None for a missing or empty target."""
    if target is None:
        return None
    return target.agg(F.max(column)).first()[0]


def after_watermark(source: DataFrame, mark, column: str = "_LOADED_AT") -> DataFrame:
    """Source rows strictly newer than ``mark``.  A NULL mark (first run, or an existing but
    empty target) loads everything -- the original's ``> NULL`` would load nothing, forever.
    The mark is a literal, so the filter reaches the Parquet scan (row-group skipping)."""
    if mark is None:
        return source
    return source.where(F.col(column) > F.lit(mark))


def after_watermark_subquery(source: DataFrame, target: DataFrame, column: str = "_LOADED_AT",
                             target_column: str = "_loaded_at") -> DataFrame:
    """The same filter as one plan with a scalar subquery (no driver round trip)."""
    mark = target.select(F.max(target_column)).scalar()
    return source.where(F.coalesce(F.col(column) > mark, F.lit(True)))


# ------------------------------------------------------------------- I2 / I3 upsert

def sync_columns(target: DataFrame, columns: list[str]) -> DataFrame:
    """Align the target to the new column list -- new columns NULL, dropped ones gone."""
    missing = [c for c in columns if c not in target.columns]
    out = target
    for c in missing:
        out = out.withColumn(c, F.lit(None))
    return out.select(*columns)


def upsert(target: DataFrame | None, batch: DataFrame, key: str | list[str],
           check_unique: bool = True) -> DataFrame:
    """Rows of ``batch`` replace target rows with the same key; the rest are inserted.
    The batch is checked for key uniqueness first (a duplicate key would duplicate rows) unless
    the caller's batch is unique by construction (grouped on the key), which spares a pass.  The
    check, the anti join and the union each read the batch: pass one that is stored."""
    keys = [key] if isinstance(key, str) else list(key)
    if check_unique:
        dup = batch.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"batch has duplicate key {dup[0][:len(keys)]}")
    if target is None:
        return batch
    target = sync_columns(target, batch.columns)
    kept = anti_join(target, batch.select(*keys), keys)
    return kept.unionByName(batch)


# ------------------------------------------------------------------- I6 affected groups

def affected_groups(new_rows: DataFrame, child_col: str, period_col: str, dim: DataFrame,
                    child_key: str = "municipality_name", parent: str = "region_name") -> DataFrame:
    """The (parent, period) groups touched by a batch of child rows."""
    m = dim.select(F.col(child_key).alias("_child"), F.col(parent).alias("_parent"))
    j = join_dimension(new_rows.select(child_col, period_col), m, F.col(child_col) == F.col("_child"),
                       "inner")
    return j.select(F.col("_parent").alias(parent), F.col(period_col).alias("period_year")).distinct()


def cells_of_groups(groups: DataFrame, dim: DataFrame, child_key: str = "municipality_name",
                    parent: str = "region_name") -> DataFrame:
    """The (child, period) cells that make up the affected groups, as (_child, _year)."""
    g = groups.select(F.col(parent).alias("_g_parent"), F.col("period_year").alias("_year"))
    m = dim.select(F.col(child_key).alias("_child"), F.col(parent).alias("_parent"))
    return m.join(g, F.col("_parent") == F.col("_g_parent")).select("_child", "_year")


# ------------------------------------------------------------------- ledger of applied loads

def loads(raw: dict[str, DataFrame], column: str = "_LOADED_AT") -> DataFrame:
    """The load instants of each source, as (source, loaded_at)."""
    parts = [df.select(F.lit(name).alias("source"), F.col(column).alias("loaded_at")).distinct()
             for name, df in raw.items()]
    return reduce(DataFrame.unionByName, parts)


def not_applied(raw: DataFrame, source: str, applied: DataFrame | None, column: str = "_LOADED_AT") -> DataFrame:
    """Rows of the loads that the ledger does not have for this source, however late they come.

    Every source has its own entries, so a load of one that arrives after a newer load of another
    is still new.  The ledger has a row per load; AQE broadcasts it by its measured size."""
    if applied is None:
        return raw
    done = applied.where(F.col("source") == F.lit(source)).select(F.col("loaded_at").alias("_done"))
    return raw.join(done, F.col(column) == F.col("_done"), "left_anti")
