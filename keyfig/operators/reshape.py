"""Reshaping operators: sentinel clean-up (S4), EAV pivot (A1, A2), latest-load dedupe (I5),
dimension elimination (A12) and the inverse pivot used by property tests."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.functions.columns import exact_sum, null_if_sentinel
from keyfig.plans.config import DEFAULT_SENTINELS


def clean_sentinels(df: DataFrame, columns: Iterable[str] | None = None,
                    sentinels: Iterable[str] = DEFAULT_SENTINELS) -> DataFrame:
    """Replace suppression markers by NULL in every (or the given) string column."""
    sentinels = list(sentinels)
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([null_if_sentinel(c, sentinels).alias(c) if c in targets else F.col(c)
                      for c in df.columns])


def stringify(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every column (but ``keep``) as text; NULL stays NULL, never the text 'None'/'nan'."""
    keep = set(keep)
    return df.select([F.col(c) if c in keep else F.col(c).cast("string").alias(c)
                      for c in df.columns])


def pivot_metrics(df: DataFrame, group_cols: list[str], metric_col: str, value_col: str,
                  mapping: Mapping[str, str], loaded_at: str | None = None,
                  resolve: str = "latest", loaded_at_alias: str = "_loaded_at") -> DataFrame:
    """Long (one row per metric member) -> wide (one column per mapped member).

    One aggregation, so one shuffle of partial aggregates on ``group_cols``.  Members missing
    from a group give NULL; members not in ``mapping`` are ignored but still make the group.

    ``resolve="latest"``: the value of the newest load (``loaded_at``) of each member wins (a
    suppressed newest value gives NULL).  ``max_by(value, ts)`` keeps a fixed-width buffer, so
    this stays a hash aggregation with map-side combine: no sort, no window, and a hot group is
    combined before the shuffle.  A well-formed extract has one row per cell and load (checked
    by ``unique``); two rows of one cell in the *same* load resolve arbitrarily.
    ``resolve="max"``: the largest value across all loads.
    """
    aggs = []
    for member, name in mapping.items():
        hit = F.col(metric_col) == F.lit(member)
        if resolve == "latest" and loaded_at is not None:
            aggs.append(F.max_by(F.when(hit, F.col(value_col)), F.when(hit, F.col(loaded_at))).alias(name))
        elif resolve in ("latest", "max"):
            aggs.append(F.max(F.when(hit, F.col(value_col))).alias(name))
        else:
            raise ValueError(f"unknown resolve mode {resolve!r}")
    if loaded_at is not None:
        aggs.append(F.max(loaded_at).alias(loaded_at_alias))
    return df.groupBy(*group_cols).agg(*aggs)


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the row that is greatest in ``order`` (e.g. newest ``_loaded_at``,
    then the larger value).  ``max`` over a struct is a (sort-based) aggregation with a partial
    step: each map task keeps one row per key, so a hot key is combined before the shuffle
    instead of being collected into one task, as a ``row_number`` window would."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("_row")
    out = df.groupBy(*keys).agg(F.max(packed).alias("_row"))
    return out.select(*keys, *[F.col("_row").getField(c).alias(c) for c in order + rest]).select(
        *df.columns)


def latest_value(df: DataFrame, keys: list[str], value: str, loaded_at: str) -> DataFrame:
    """I5 for fixed-width rows: per key, the value (and any other columns) of the newest load.
    ``max_by`` keeps a fixed-width buffer, so this is a hash aggregation with map-side combine.
    Two rows of one key in the same load resolve arbitrarily (``unique`` reports them)."""
    others = [c for c in df.columns if c not in keys and c not in (value, loaded_at)]
    return (df.groupBy(*keys)
            .agg(F.max_by(value, loaded_at).alias(value), F.max(loaded_at).alias(loaded_at),
                 *[F.max_by(c, loaded_at).alias(c) for c in others])
            .select(*df.columns))


def eliminate_dimension(df: DataFrame, drop: Iterable[str], value_col: str,
                        keep: Iterable[str] | None = None, alias: str | None = None) -> DataFrame:
    """Totals over the omitted dimensions (what a source returns when a dimension is left
    out of the request)."""
    drop = set(drop)
    keep = [c for c in (keep if keep is not None else df.columns) if c not in drop and c != value_col]
    return df.groupBy(*keep).agg(exact_sum(value_col).alias(alias or value_col))


def unpivot_metrics(df: DataFrame, id_cols: list[str], mapping: Mapping[str, str],
                    metric_col: str, value_col: str) -> DataFrame:
    """Inverse of :func:`pivot_metrics` (wide -> long), NULL cells dropped."""
    stacked = df.unpivot(id_cols, list(mapping.values()), "_name", value_col)
    inverse = {v: k for k, v in mapping.items()}
    member = None
    for name, label in inverse.items():
        cond = F.col("_name") == F.lit(name)
        member = F.when(cond, F.lit(label)) if member is None else member.when(cond, F.lit(label))
    return (stacked.where(F.col(value_col).isNotNull())
            .select(*id_cols, member.alias(metric_col), value_col))
