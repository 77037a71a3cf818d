"""Slowly changing dimension, type 2 (H1 check strategy, H2 hard deletes).

History rows carry ``valid_from`` / ``valid_to`` (NULL = current) and ``scd_id``.  A snapshot is
one full outer join of the current versions with the new extract on the key -- a single shuffle
on the key, whatever the dimension's size.

:class:`History` keeps open and closed versions apart.  Open ones are a keyed table of change files
(:mod:`keyfig.operators.changes`), closed ones are only ever appended, by the month they closed in.
A snapshot reads the open versions, writes those that it opens or closes, and never reads or copies
a closed one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.operators.changes import Store
from keyfig.operators.incremental import publish
from keyfig.session import work_path

SCD_COLUMNS = ["scd_id", "valid_from", "valid_to"]


def _scd_id(key: str, ts_col: str):
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(ts_col).cast("string")))


def snapshot(history: DataFrame | None, current: DataFrame, key: str, check_cols: list[str],
             snapshot_ts, updated_at: str = "updated_at",
             invalidate_hard_deletes: bool = True) -> DataFrame:
    """Apply one snapshot of ``current`` taken at ``snapshot_ts`` to ``history``.

    * new key -> open version from ``snapshot_ts``;
    * any checked column differs (NULL-safe) -> close the open version, open a new one;
    * key gone from ``current`` -> close its open version (H2), if enabled;
    * a key that comes back later opens a fresh version.

    A NULL key would match nothing and its history would break off, so it fails the job.
    """
    ts = F.lit(snapshot_ts).cast("timestamp_ntz")
    data_cols = [c for c in current.columns if c != updated_at]
    out_cols = [*data_cols, updated_at, *SCD_COLUMNS]
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"snapshot row without {key}"))).otherwise(F.col(key))
    cur = current.select(*data_cols).withColumn(key, checked.cast(current.schema[key].dataType)).withColumn(updated_at, ts)
    if history is None:
        opened = cur.withColumn("valid_from", ts).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        return opened.withColumn("scd_id", _scd_id(key, "valid_from")).select(*out_cols)
    closed = history.where(F.col("valid_to").isNotNull()).select(*out_cols)
    open_ = history.where(F.col("valid_to").isNull())

    # one full outer join; each pair gives the old version (kept or closed), a new one, or both
    o = open_.select(F.col(key).alias("_key"), F.struct(*out_cols).alias("_old"))
    n = cur.select(F.col(key).alias("_key"), F.struct(*data_cols, updated_at).alias("_new"))
    j = o.join(n, "_key", "full_outer")
    old, new = F.col("_old"), F.col("_new")
    changed = reduce(or_, [~old[c].eqNullSafe(new[c]) for c in check_cols])
    valid_to = (F.when(new.isNull(), ts if invalidate_hard_deletes else old["valid_to"])
                .when(changed, ts).otherwise(old["valid_to"]))
    old_row = F.when(old.isNotNull(), F.struct(*[old[c].alias(c) for c in out_cols[:-1]], valid_to.alias("valid_to")))
    new_row = F.when(new.isNotNull() & (old.isNull() | changed), F.struct(
        *[new[c].alias(c) for c in [*data_cols, updated_at]],
        F.md5(F.concat_ws("|", new[key].cast("string"), ts.cast("string"))).alias("scd_id"),
        ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")))
    versions = j.select(F.explode(F.array_compact(F.array(old_row, new_row))).alias("_row")).select("_row.*")
    return closed.unionByName(versions)


class History:
    """The history of a dimension below ``base``."""

    OPEN, CLOSED, ALL, MONTH = "open", "closed", "_all", "_closed"

    def __init__(self, spark: SparkSession, base: str, key: str, check_cols: list[str], buckets: int = 8):
        self.store, self.key, self.check_cols, self.buckets = Store(spark, base), key, check_cols, buckets

    def _schema(self) -> T.StructType | None:
        noted = self.store.state()["notes"].get("schema")
        return T.StructType.fromJson(noted) if noted else None

    def open(self) -> DataFrame:
        """The current version of every key."""
        schema = self._schema()
        return self.store.read(self.OPEN, T.StructType([*schema.fields, T.StructField(self.ALL, T.IntegerType())]), self.ALL, [self.key]).drop(self.ALL)

    def closed(self, months: list[str] | None = None) -> DataFrame:
        """The versions that ended, in all or some months (``2024-01``)."""
        schema = self._schema()
        return self.store.read(self.CLOSED, T.StructType([*schema.fields, T.StructField(self.MONTH, T.StringType())]), self.MONTH, values=months).drop(self.MONTH)

    def read(self) -> DataFrame:
        return self.open().unionByName(self.closed())

    def _commit(self, rows: DataFrame, name: str) -> None:
        opened, ended = rows.where("valid_to IS NULL"), rows.where("valid_to IS NOT NULL")
        gone = ended.select(self.key).distinct().withColumn(self.ALL, F.lit(0))
        staged = [self.store.stage(opened.withColumn(self.ALL, F.lit(0)), self.OPEN, self.ALL, [self.key], self.buckets, gone=gone),
                  self.store.stage(ended.withColumn(self.MONTH, F.date_format("valid_to", "yyyy-MM")), self.CLOSED, self.MONTH)]
        self.store.commit(staged, load=name, notes={"schema": rows.schema.jsonValue()})

    def adopt(self, history: DataFrame) -> None:
        """Starts from a history kept as one table."""
        self._commit(history, "adopted")

    def take(self, current: DataFrame, snapshot_ts, updated_at: str = "updated_at", invalidate_hard_deletes: bool = True) -> None:
        """Applies a snapshot (see :func:`snapshot`); one of an instant that was taken before changes nothing."""
        name = str(snapshot_ts)
        if name in self.store.state()["loads"]:
            return
        before = self.open() if self._schema() is not None else None
        versions = snapshot(before, current, self.key, self.check_cols, snapshot_ts, updated_at, invalidate_hard_deletes)
        ts = F.lit(snapshot_ts).cast("timestamp_ntz")
        touched = versions.where((F.col("valid_from") == ts) | F.col("valid_to").isNotNull())
        self._commit(publish(touched, work_path(current.sparkSession, "snapshot")), name)
        self.store.compact(self.OPEN, T.StructType([*self._schema().fields, T.StructField(self.ALL, T.IntegerType())]), self.ALL, [self.key], buckets=self.buckets)
