"""Landed extract files as a stream.

Each new file is processed once (the streaming checkpoint replaces the load watermark); every
micro-batch becomes one change of a "latest cell" table (:mod:`keyfig.operators.changes`), in which
the newest load of a cell wins.  A batch writes its own cells only and reads nothing back.

The change carries the query's id and the batch's number.  A batch that runs again, because the
driver died between the commit of the table and that of the checkpoint, finds its number in the
table and adds nothing; one that died before the commit left nothing visible.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyfig.operators.changes import Store
from keyfig.operators.reshape import latest_by
from keyfig.sources import sink

CELLS = "cells"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps over restarts, from its checkpoint."""
    return json.loads(sink.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def stream_latest_cells(spark: SparkSession, landing: str, schema: T.StructType, keys: list[str],
                        order: list[str], target: str, checkpoint: str, partition_col: str,
                        files_per_batch: int | None = None, fmt: str = "parquet", buckets: int = 4,
                        compact_after: int = 16, keep: int = 4) -> DataFrame:
    """Process every file under ``landing`` not yet seen by ``checkpoint``; returns the current
    latest-cell table, partitioned by ``partition_col``, which must be among ``keys``.  All waiting
    files are one batch unless ``files_per_batch`` says otherwise.  A bucket with over
    ``compact_after`` changes is written anew, and what the ``keep`` last versions do not show goes."""
    if partition_col not in keys:
        raise ValueError(f"the partition column {partition_col} is not among the keys")
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(landing)
    store = Store(spark, target)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        query = query_id(spark, checkpoint)
        if store.has_batch(query, batch_id):
            return
        store.commit([store.stage(latest_by(batch, keys, order), CELLS, partition_col, keys, buckets)], batch=(query, batch_id))
        if store.compact(CELLS, schema, partition_col, keys, order, buckets, compact_after):
            store.vacuum(keep)

    query = (stream.writeStream.foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return store.read(CELLS, schema, partition_col, keys, order)
