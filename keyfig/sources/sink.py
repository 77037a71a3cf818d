"""Sinks (S7, S8, S13, U3, I4): append or overwrite Parquet, create on first write, count the
rows written without a second pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table_exists(spark: SparkSession, path_or_name: str) -> bool:
    """A catalog table, or a Parquet folder with data."""
    if "/" not in path_or_name:
        return spark.catalog.tableExists(path_or_name)
    if not path_exists(spark, path_or_name):
        return False
    try:
        spark.read.parquet(path_or_name).limit(0).collect()
        return True
    except Exception:  # noqa: BLE001 -- a folder without Parquet data
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence of a file or folder on the cluster file system (any Hadoop scheme)."""
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(jsc.hadoopConfiguration()).exists(p))
    except Exception:  # noqa: BLE001 -- no JVM gateway (remote session): try a read
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception:  # noqa: BLE001
            return False


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on the cluster file system."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    return [st.getPath().getName() for st in p.getFileSystem(jsc.hadoopConfiguration()).listStatus(p)]


def make_dir(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def partition_folder(spark: SparkSession, column: str, value) -> str:
    """The folder name that Spark's writer gives a partition value."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else utils.escapePathName(str(value))
    return f"{column}={text}"


def sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names, relative to ``path``, and bytes of the data files below it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    root, out = p.toUri().getPath().rstrip("/") + "/", []
    while found.hasNext():
        st = found.next()
        name = st.getPath().toUri().getPath().removeprefix(root)
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append((name, st.getLen()))
    return out


def read_text(spark: SparkSession, file: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file that must not exist yet; it appears whole or not at all."""
    jvm = spark.sparkContext._jvm
    p, draft = jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.hadoop.fs.Path(f"{file}.{uuid.uuid4().hex}.tmp")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(file)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files that a scan of ``path`` (file, folder or glob) reads, in order."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(jsc.hadoopConfiguration())
    out, todo = [], list(fs.globStatus(p) or [])
    while todo:
        st = todo.pop()
        name = st.getPath().getName()
        if st.isDirectory():
            todo += [x for x in fs.listStatus(st.getPath())
                     if not (x.getPath().getName().startswith(("_", ".")) and "=" not in x.getPath().getName())]
        elif not name.startswith(("_", ".")) and st.getLen() > 0:
            out.append(st.getPath().toString())
    return sorted(out)


def first_line(spark: SparkSession, file: str, encoding: str = "UTF-8") -> str:
    """The first line of a text file (compressed ones too) on the cluster file system."""
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(jsc.hadoopConfiguration()).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(jsc.hadoopConfiguration()).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        codec.createInputStream(stream) if codec is not None else stream, encoding))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def write_table(df: DataFrame, path: str, overwrite: bool = False,
                partition_by: list[str] | None = None) -> int:
    """Append (default; U3) or overwrite (full refresh; I4); the folder is created when
    absent.  Returns rows written, observed during the write."""
    obs = Observation(f"sink_{uuid.uuid4().hex}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    # a refresh replaces the whole table, whatever the session says about partitions
    writer = out.write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def materialise(df: DataFrame, how: str, name: str | None = None, path: str | None = None,
                keys: list[str] | None = None, partition: str | None = None, buckets: int = 8) -> DataFrame:
    """``view`` registers a temp view (work happens on read); ``table`` writes the result
    once and returns it read back, which also cuts the lineage; ``incremental`` writes the rows as
    a change of the table, in which they replace those of the same ``keys``, and returns the whole
    table.  Its columns are those of ``df``: earlier rows have nulls in new ones, old ones go.
    ``df`` has a key once (the caller's ``unique`` check)."""
    if how == "view":
        df.createOrReplaceTempView(name or "view")
        return df
    if how == "table":
        write_table(df, path, overwrite=True)
        return df.sparkSession.read.parquet(path)
    if how == "incremental":
        from keyfig.operators.changes import Store
        store, column = Store(df.sparkSession, path), partition or "_part"
        schema = df.schema if partition else df.withColumn(column, F.lit(0)).schema
        rows = df if partition else df.withColumn(column, F.lit(0))
        store.commit([store.stage(rows, "rows", column, keys, buckets)])
        return store.read("rows", schema, column, keys).select(*df.columns)
    raise ValueError(how)
