"""Helpers shared by the training-data operators: row-wise Arrow maps, byte-level words, tables.

Row rule of every operator built on :func:`annotate`: one output row per input row, in place;
null texts count as empty unless an operator says otherwise; extra columns pass through and may
carry any name, because results travel in one struct column whose name is made unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from keyfig.session import work_path

#: Text bytes that one numpy step works on; longer texts form a step of their own.
STEP_BYTES = 4 << 20


def fresh(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with as many underscores as make it unlike every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back: cuts the lineage for good."""
    path = work_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without a copy, and the row offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with at most ``limit`` text bytes each (or one longer row)."""
    _, offsets = text_bytes(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = b


def annotate(df: DataFrame, make: Callable[[], Callable[[pa.Array], pa.Array]], result: str,
             text: str = "text", keep: list[str] | None = None, name: str = "result") -> tuple[DataFrame, str]:
    """``df`` with one struct column of results per row, and that column's name.

    ``make`` runs once per task and returns a function from a slice of the text column to a
    struct array of the same length.  ``keep`` lists the columns to return (default: all).
    """
    name = fresh(df, name)
    keep = list(df.columns) if keep is None else keep
    fields = [f for k in keep for f in df.schema.fields if f.name == k]
    kind = StructType.fromDDL(f"r {result}").fields[0].dataType
    schema = StructType([*fields, StructField(name, kind)])
    # the text travels first, under its position, so that no name can be mistaken for it
    sent = df.select(F.col(f"`{text}`").cast("string").alias("_text"), *(F.col(f"`{k}`") for k in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for a, b in steps(batch.column(0)):
                part = batch.slice(a, b - a)
                made = work(part.column(0))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], names=[*keep, name])

    return sent.mapInArrow(run, schema), name


# --- words as bytes ------------------------------------------------------------------------

#: Bytes that belong to a word: 0-9, A-Z, a-z and everything beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
#: A-Z to a-z, all other bytes to themselves.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 2**62)) * 4 + 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, STEP_BYTES + (1 << 16))
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(size, base & (2**64 - 1), np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
        del _POWERS[:-2]
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a copy), so that low and high bits are equally good."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every lower-cased word, in order, and the rows' offsets into the words.

    Words never cross rows.  Long texts are worked on in pieces cut between words, so that the
    temporary arrays stay at a few times ``STEP_BYTES``.
    """
    n, out, starts_out = len(data), [], []
    edges = np.unique(offsets)
    a = 0
    while a < n:
        b = min(a + STEP_BYTES, n)
        if b < n:  # to the next place where no word is cut
            nxt = edges[np.searchsorted(edges, b)]
            while b < nxt and IS_WORD[data[b - 1]]:
                gap = np.flatnonzero(~IS_WORD[data[b:min(b + 65536, nxt)]])
                b = b + int(gap[0]) + 1 if len(gap) else min(b + 65536, nxt)
        part = data[a:b]
        m = IS_WORD[part]
        first, last = m.copy(), m.copy()
        first[1:] &= ~m[:-1]
        last[:-1] &= ~m[1:]
        inner = edges[np.searchsorted(edges, a, side="right"):np.searchsorted(edges, b)] - a
        first[inner] = m[inner]
        last[inner - 1] = m[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(starts):
            up, down = _powers(len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[part]] * up[:len(part)], out=total[1:])
            out.append(mix((total[ends] - total[starts]) * down[starts]))
            starts_out.append(starts + a)
        a = b
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts_out)
    return np.concatenate(out), np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words per row; a shorter row with words has one shingle."""
    n_words = np.diff(offsets)
    counts = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(counts, out=out[1:])
    if not len(words):
        return np.zeros(0, np.uint64), out
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    at = np.arange(out[-1]) - np.repeat(out[:-1] - offsets[:-1], counts)
    room = np.repeat(offsets[1:], counts) - at
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        part = padded[at + k]
        part[room <= k] = np.uint64(0x9E3779B97F4A7C15)
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + part)
    return h, out


# --- joins -----------------------------------------------------------------------------------

#: Rows of fixed width up to which a counted side is broadcast, and rows of its hot part beyond.
BROADCAST_ROWS, HOT_ROWS = 10_000, 1_000


def lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str, rows: int | None = None) -> DataFrame:
    """Left join of ``left`` with a stored table that has one narrow row per key.

    The table is counted.  Up to ``BROADCAST_ROWS`` rows it is broadcast; beyond, only the
    ``HOT_ROWS`` keys of the greatest ``weight`` (their count on the left) are, so that no key
    gathers its rows in one task, and the rest is joined by shuffle: the plan does not wait for
    statistics, so its cost grows evenly.  Keys must not be null in ``right``.
    """
    rows = right.count() if rows is None else rows
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right.drop(weight)), keys, "left")
    hot = right.orderBy(F.desc(weight), *keys).limit(HOT_ROWS)
    mark = fresh(left, "hot")
    marked = left.join(F.broadcast(hot.select(*keys, F.lit(True).alias(mark))), keys, "left")
    warm = hot.drop(weight)
    return (marked.where(F.col(mark).isNotNull()).drop(mark).join(F.broadcast(warm), keys, "left")
            .unionByName(marked.where(F.col(mark).isNull()).drop(mark).join(right.drop(weight).hint("merge"), keys, "left")))
