"""Join helpers.

The only place the library broadcasts: :func:`join_dimension` broadcasts the dimension side only
after proving it has at most ``max_rows`` rows; beyond that the join is left to the planner
(sort-merge / shuffled hash, AQE may still switch to broadcast and split skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows for an explicit broadcast (a few MB for reference tables).
BROADCAST_MAX_ROWS = 100_000


# Bytes of a broadcast side at most (rows may be wide).
BROADCAST_MAX_BYTES = 64 << 20

_CHECKED: dict[tuple, list[tuple[DataFrame, bool]]] = {}


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes as text; touches at
    most ``max_rows + 1`` rows.  The answer is kept per session for frames with the same
    semantics, so a dimension that many joins of a query use is counted once; frames read from
    files that were written since have another file index and are counted again."""
    known = _CHECKED.setdefault((df.sparkSession.sparkContext.applicationId, df.semanticHash(), max_rows), [])
    for frame, answer in known:
        if frame.sameSemantics(df):
            return answer
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    known.append((df, n <= max_rows and size <= max_bytes))
    return known[-1][1]


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Fact-to-dimension join; the dimension is broadcast only when its size is proven small."""
    side = F.broadcast(dim) if has_at_most(dim, max_rows) else dim
    return fact.join(side, on, how)


def distinct_lookup(dim: DataFrame, key: str, value: str) -> DataFrame:
    """J1 lookup side: one row per (key, value), NULL keys removed (no fan-out)."""
    return dim.select(key, value).where(F.col(key).isNotNull()).distinct()


def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` that have a match in ``keys`` (never duplicates ``df`` rows)."""
    return join_dimension(df, keys, on, how="left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` without a match in ``keys``."""
    return df.join(keys, on, "left_anti")
