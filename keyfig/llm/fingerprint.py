"""SimHash fingerprints of documents and a search within a Hamming radius.

Terms are pairs of consecutive words (a single word is its own term); a term weighs as much as
it occurs, and its 64-bit hash votes with that weight on each signed bit.  A bit is set if more
than half of the weight is for it.  Texts without words have fingerprint 0.

The search cuts a fingerprint into ``radius + 2`` blocks.  Two fingerprints within the radius
agree on at least two of them, so there is a table per pair of blocks, keyed by these bits, and
one of the tables brings any such pair together.  Equal fingerprints are one entry with a count.

``with_next`` pairs every document with the next one in the order of (id, text), the last with
the first: documents are dealt to ranges of id and beginning of text (so rows of one id, or of
none, are many ranges), the first document of each range also travels to the range before, and
each task walks a range in order, holding a batch at a time.

Defined results: null texts are empty; null ids come first; documents that repeat follow one
another; a single document is its own next; long texts are read whole, a batch at a time.  An empty
table gives no rows.  Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keyfig.llm.common import shingle_hashes, shuffle_parts, steps, text_bytes, word_hashes

TERM_WORDS, RADIUS = 2, 3
#: Code points of a text that ranges may be cut at, and rows a range that the cuts are taken from.
HEAD, SAMPLED = 40, 64
_GROUPS = 1 << 13


def simhash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The 64-bit fingerprint of every row."""
    terms, at = shingle_hashes(*word_hashes(data, offsets), TERM_WORDS)
    votes, n = np.zeros((len(offsets) - 1, 64), np.int64), np.diff(at)
    # at most 255 terms of a row at a time, so that one byte holds a bit's votes
    groups = -(-n // 255)
    nth = np.arange(groups.sum()) - np.repeat(np.cumsum(groups) - groups, groups)
    start = np.repeat(at[:-1], groups) + 255 * nth
    row = np.repeat(np.arange(len(n)), groups)
    for a in range(0, len(start), _GROUPS):
        some = slice(a, a + _GROUPS)
        end = start[a + _GROUPS] if a + _GROUPS < len(start) else len(terms)
        bits = np.unpackbits(terms[start[a]:end].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        sums = np.add.reduceat(bits, start[some] - start[a], axis=0).view(np.uint8)
        first = np.flatnonzero(np.diff(row[some], prepend=-1))
        votes[row[some][first]] += np.add.reduceat(sums, first, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > n[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of bits that differ."""
    return 1 - np.bitwise_count(a ^ b) / 64


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of another text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, code points, fingerprint, and the edited text's and next one's figures."""
    spark, parts = docs.sparkSession, shuffle_parts(docs.sparkSession)
    own_id, own_text = F.col(f"`{doc_id}`").cast("long"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # ranges are cut by id and, as many rows may have one id or none, by the beginning of the text
    base = docs.select(F.coalesce(own_id, F.lit(-2**63)).alias("key"), own_id.alias("doc_id"), own_text.alias("text")).withColumn("head", F.left("text", F.lit(HEAD)))
    heads = base.select("key", "head")
    every = max(1, docs.count() // (SAMPLED * parts))
    sample = sorted((r["key"], r["head"]) for r in heads.where(F.pmod(F.xxhash64("key", "head"), F.lit(every)) == 0).distinct().collect())
    cuts = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, x) for x in zip(k.tolist(), h.tolist(), strict=True)], dtype="int32")

    # one row a range: where it begins
    first = F.min(F.struct("key", "head"))
    begins = {r["part"]: (r["first"]["key"], r["first"]["head"]) for r in heads.groupBy(number("key", "head").alias("part")).agg(first.alias("first")).collect()}
    order = sorted(begins)
    before = {begins[p]: order[k - 1] for k, p in enumerate(order)}  # the very first one follows the last

    @F.pandas_udf("array<int>")
    def ranges(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([[bisect_right(cuts, x), before[x]] if x in before else [bisect_right(cuts, x)] for x in zip(k.tolist(), h.tolist(), strict=True)])

    dealt = (base.withColumn("in", ranges("key", "head")).select("key", "doc_id", "text", F.posexplode("in").alias("extra", "part"))
             .repartitionById(parts, F.col("part")).sortWithinPartitions("part", "extra", "key", "text"))
    return dealt.select("part", "extra", "doc_id", "text").mapInArrow(_walk, RESULT)


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, bits long")
_NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.RecordBatch | None = None
    for batch in batches:
        for a, b in steps(batch.column(3), 2 << 20):
            rows = batch.slice(a, b - a)
            if held is not None:
                rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
            if rows.num_rows > 1:
                yield _pairs(rows)
            held = rows.slice(rows.num_rows - 1)


def _pairs(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Figures of all rows but the last and the copies from the range that follows."""
    texts = rows.column(3).to_pylist()
    own = simhash(*text_bytes(rows.column(3)))
    is_own = np.flatnonzero(rows.column(1).to_numpy()[:-1] == 0)
    changed = [edited(texts[i], texts[i + 1]) for i in is_own]
    other = simhash(*text_bytes(pa.array(changed, pa.large_string())))
    mine, after = own[is_own], own[is_own + 1]
    return pa.RecordBatch.from_arrays([
        rows.column(2).take(pa.array(is_own)), pa.array([len(texts[i]) for i in is_own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([f"{x:016x}" for x in mine.tolist()], pa.string()), pa.array([f"{x:016x}" for x in other.tolist()], pa.string()),
        pa.array(likeness(mine, other)), pa.array(likeness(mine, after)), pa.array(mine.view(np.int64))], names=_NAMES)


def within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, bits: str = "bits") -> DataFrame:
    """Per distinct fingerprint of ``queries``: how many rows of ``prints`` lie within the radius."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in pick) for pick in combinations(range(blocks), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]

    def tables(df: DataFrame) -> DataFrame:
        return df.select("*", F.posexplode(F.array(*(F.col("bits").bitwiseAND(F.lit(m)) for m in signed))).alias("table", "block"))

    one = prints.groupBy(F.col(bits).alias("bits")).agg(F.count("*").alias("n"))
    asked = queries.select(F.col(bits).alias("bits")).distinct()
    pairs = (tables(asked).withColumnRenamed("bits", "query").join(tables(one), ["table", "block"])
             .where(F.bit_count(F.col("query").bitwiseXOR(F.col("bits"))) <= radius)
             # a pair counts in the first table only that brings it together
             .where(F.array_position(F.array(*((F.col("query").bitwiseXOR(F.col("bits"))).bitwiseAND(F.lit(m)) == 0 for m in signed)), True) == F.col("table") + 1))
    return pairs.groupBy(F.col("query").alias("bits")).agg(F.sum("n").alias("n_within"))
