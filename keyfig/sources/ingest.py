"""Config-driven ingest (S9) and the seed reader.

``SourceSpec`` describes one landed extract; :func:`ingest_all` lands every spec, skipping (and
reporting) a failing or empty one while the others continue, and returns a status table.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keyfig.sources.delimited import land_extract
from keyfig.sources.sink import write_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceSpec:
    source_id: str                 # id of the source table
    target: str                    # raw table name
    paths: tuple[str, ...]         # landed files or folders (one per chunk, S3)
    columns: tuple[str, ...]       # expected header, in order
    sep: str = ";"
    description: str = field(default="")


def landing_specs(landing: str, source_ids: dict[str, str] | None = None) -> list[SourceSpec]:
    """One spec per raw table, reading every file under ``<landing>/<source id>/`` (a folder
    may hold several chunk files of one extract, S3)."""
    from keyfig.plans.config import RAW_SPECS, SOURCE_IDS
    ids = source_ids or SOURCE_IDS
    return [SourceSpec(ids[s.name], s.name, (f"{landing.rstrip('/')}/{ids[s.name]}",), s.columns)
            for s in RAW_SPECS if s.name in ids]


STATUS_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("message", T.StringType())])


def land_all(spark: SparkSession, specs: list[SourceSpec], loaded_at=None) -> tuple[dict[str, DataFrame], list[tuple]]:
    """The extract of every spec that has one, by target, and a status row per spec that has
    none.  One bad source does not stop the others."""
    from keyfig.sources.sink import path_exists
    landed: dict[str, DataFrame] = {}
    status: list[tuple] = []
    for spec in specs:
        missing = [p for p in spec.paths if not path_exists(spark, p)]
        if missing:
            log.warning("no landed file for %s: %s", spec.source_id, missing)
            status.append((spec.source_id, spec.target, "failed", 0, "path not found"))
            continue
        try:
            df = land_extract(spark, list(spec.paths), list(spec.columns), spec.source_id, loaded_at, sep=spec.sep)
            if df.isEmpty():
                log.warning("no data for %s", spec.source_id)
                status.append((spec.source_id, spec.target, "empty", 0, "no rows"))
            else:
                landed[spec.target] = df
        except Exception as exc:  # noqa: BLE001 -- reported in the status
            log.warning("ingest of %s failed: %s", spec.source_id, exc)
            status.append((spec.source_id, spec.target, "failed", 0, type(exc).__name__))
    return landed, status


def ingest_all(spark: SparkSession, specs: list[SourceSpec], warehouse: str, loaded_at=None,
               overwrite: bool = False) -> DataFrame:
    """Land each spec into ``<warehouse>/<target>``; returns (source_id, target, status, rows,
    message) per spec.  Only counts travel to the driver."""
    landed, status = land_all(spark, specs, loaded_at)
    for spec in specs:
        if spec.target not in landed:
            continue
        try:
            rows = write_table(landed[spec.target], f"{warehouse}/{spec.target}", overwrite=overwrite)
            status.append((spec.source_id, spec.target, "loaded", rows, ""))
        except Exception as exc:  # noqa: BLE001 -- e.g. a malformed line further down a file
            log.warning("ingest of %s failed: %s", spec.source_id, exc)
            status.append((spec.source_id, spec.target, "failed", 0, type(exc).__name__))
    return spark.createDataFrame(status, STATUS_SCHEMA)


SEED_SCHEMA = T.StructType([
    T.StructField("municipality_code", T.IntegerType(), False),
    T.StructField("municipality_name", T.StringType(), False),
    T.StructField("region_code", T.IntegerType(), False),
    T.StructField("region_name", T.StringType(), False)])


def read_seed(spark: SparkSession, path: str, schema: T.StructType = SEED_SCHEMA) -> DataFrame:
    """Static reference CSV with an explicit schema (comma-separated, header row)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
