"""Delimited extracts: scan (S1), header normalisation (S2), chunked landing/reading (S3, U1),
audit columns (S5) and export (S14)."""

from __future__ import annotations

import uuid
from functools import reduce
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyfig.functions.columns import normalise_header
from keyfig.operators.joins import join_dimension
from keyfig.operators.reshape import clean_sentinels
from keyfig.operators.windows import with_position
from keyfig.plans.config import DEFAULT_SENTINELS
from keyfig.sources.sink import data_files, first_line, list_dir


def normalise_headers(df: DataFrame) -> DataFrame:
    """Normalised column names; two headers that normalise alike are an error."""
    names = [normalise_header(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"headers {seen[new]!r} and {raw!r} both normalise to {new!r}")
        seen[new] = raw
    return df.toDF(*names)


def read_delimited(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None,
                   sep: str = ";", header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """``sep``-separated text with a header row, every column read as text (no inference
    pass over the data, no type drift between loads).  Headers are normalised (S2).  Columns are
    matched *by name*: each file's own first line says what its columns are (files of one header
    are one scan, the scans are united by name), so files whose columns come in another order
    line up.  With ``columns`` these are returned and a file that lacks one is an error; without,
    all files must have the same names."""
    def scan(files: str | list[str]) -> DataFrame:
        df = (spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
              .option("mode", "FAILFAST").option("inferSchema", False).csv(files))
        return normalise_headers(df)

    frames = [scan(files) for files in _files_by_header(spark, paths, encoding)] if header else []
    frames = frames or [scan(paths)]
    if columns is None:
        if any(set(f.columns) != set(frames[0].columns) for f in frames):
            raise ValueError(f"files with different columns: {[f.columns for f in frames]}")
        wanted = frames[0].columns
    else:
        wanted = [normalise_header(c) for c in columns]
        for df in frames:
            missing = [c for c in wanted if c not in df.columns]
            if missing:
                raise ValueError(f"extract lacks columns {missing}; has {df.columns}")
    return reduce(DataFrame.unionByName, [df.select(*[F.col(c).cast("string") for c in wanted]) for df in frames])


def _files_by_header(spark: SparkSession, paths: str | list[str], encoding: str) -> list[list[str]]:
    """Data files grouped by their first line, which is read through the cluster file system
    (a few bytes a file; no data row is touched)."""
    groups: dict[str, list[str]] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        for file in data_files(spark, path):
            groups.setdefault(first_line(spark, file, encoding), []).append(file)
    return list(groups.values())


def with_audit(df: DataFrame, source_id: str, loaded_at: datetime | str | None = None,
               loaded_at_col: str = "_LOADED_AT", src_col: str = "_SRC_TABLE") -> DataFrame:
    """One load instant per table (a literal, so a recomputed plan keeps it) + source id."""
    ts = loaded_at if loaded_at is not None else datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    return df.withColumns({loaded_at_col: F.lit(ts).cast("timestamp_ntz"),
                           src_col: F.lit(source_id)})


def land_extract(spark: SparkSession, paths: str | list[str], columns: list[str], source_id: str,
                 loaded_at=None, sep: str = ";", sentinels=DEFAULT_SENTINELS) -> DataFrame:
    """S1 + S2 + S4 + S5: read an extract, NULL the markers, stamp the load."""
    df = read_delimited(spark, paths, columns, sep=sep)
    return with_audit(clean_sentinels(df, sentinels=sentinels), source_id, loaded_at)


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True,
                    mode: str = "errorifexists", partition_by: list[str] | None = None) -> int:
    """Export with normalised headers; returns the number of rows written (counted by an
    ``Observation`` on the write itself, no second pass)."""
    obs = Observation(f"export_{uuid.uuid4().hex}")
    out = normalise_headers(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode).option("sep", sep).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return int(obs.get["rows"])


def chunk_ranks(df: DataFrame, column: str, chunk_size: int) -> DataFrame:
    """S3: the column's distinct values in order with their chunk number, ``chunk_size`` values
    per chunk; the values are ranked over all partitions, however many there are."""
    ranked = with_position(df.select(column).distinct(), [column], "_place")
    return ranked.select(column, F.floor((F.col("_place") - 1) / F.lit(chunk_size)).cast("int").alias("_chunk"))


def chunk_ids(df: DataFrame, column: str, chunk_size: int) -> DataFrame:
    """Chunk number per row: the ranked values joined back (broadcast behind a size check)."""
    ranks = chunk_ranks(df, column, chunk_size).withColumnRenamed(column, "_value")
    return join_dimension(df, ranks, F.col(column).eqNullSafe(F.col("_value")), "left").select(*df.columns, "_chunk")


def land_chunked(df: DataFrame, path: str, column: str, chunk_size: int, sep: str = ";") -> list[str]:
    """S3 writer: one folder per chunk (``_chunk=N``), as separate requests would deliver them;
    returns the folders that were written, in order."""
    write_delimited(chunk_ids(df, column, chunk_size), path, sep=sep, partition_by=["_chunk"])
    written = [n for n in list_dir(df.sparkSession, path) if n.startswith("_chunk=")]
    return [f"{path}/{n}" for n in sorted(written, key=lambda n: int(n.split("=")[1]))]


def read_chunks(spark: SparkSession, paths: list[str], columns: list[str] | None = None,
                sep: str = ";") -> DataFrame:
    """S3 reader / U1: all chunk files in one scan (bag union, no dedupe)."""
    return read_delimited(spark, paths, columns, sep=sep)
