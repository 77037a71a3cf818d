"""Period comparisons, ranking and top-k.

Changes against a previous period are joins on the period *arithmetic* (year - 1, quarter - 1),
not ``lag(1)``: a gap then yields NULL instead of a comparison with the wrong period, and no
window has to hold a whole entity's history in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfig.functions.columns import round_half_up
from keyfig.session import work_path


def change_vs_previous(df: DataFrame, keys: list[str], period: str, value: str,
                       step: int = 1, name: str = "change", pct: bool = False,
                       digits: int = 2) -> DataFrame:
    """Value minus (or %-change against) the value ``step`` periods earlier of the same
    entity.  ``period`` must be an integer ordinal (year, or year*4+quarter)."""
    prev = df.select(*[F.col(k).alias(f"_prev_{k}") for k in keys],
                     (F.col(period) + step).alias("_prev_period"),
                     F.col(value).alias("_prev_value"))
    cond = F.col(period) == F.col("_prev_period")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_prev_{k}"))
    j = df.join(prev, cond, "left")
    if pct:
        delta = F.when(F.col("_prev_value") != 0, (F.col(value) / F.col("_prev_value") - 1) * 100)
    else:
        delta = F.col(value) - F.col("_prev_value")
    return j.select(*df.columns, round_half_up(delta, digits).alias(name))


def last_n_periods(df: DataFrame, period: str, n: int | None) -> DataFrame:
    """O3: the ``n`` latest distinct periods (all when ``n`` is None).  Distinct periods are
    few; ``orderBy().limit()`` is a per-partition top-n then a merge, never a global sort."""
    periods = df.select(period).distinct()
    if n is None:
        return periods
    return periods.orderBy(F.col(period).desc()).limit(n)


def keep_last_n_periods(df: DataFrame, period: str, n: int | None) -> DataFrame:
    """J8 + O3: rows of ``df`` in the latest ``n`` periods, by semi join (no fan-out)."""
    if n is None:
        return df
    chosen = last_n_periods(df, period, n).withColumnRenamed(period, "_p")
    # n rows by construction, so no size check is needed
    return df.join(F.broadcast(chosen), F.col(period) == F.col("_p"), "left_semi")


def first_k_members(long: DataFrame, variable: str, member: str, k: int = 5,
                    salt_buckets: int = 64) -> DataFrame:
    """Per variable, its ``k`` smallest distinct members, joined by ','.

    Exact two-phase top-k: members are spread over ``salt_buckets`` buckets by hash, each bucket
    keeps its own k smallest, then the variable keeps the k smallest of those candidates.  A
    variable with billions of members never lands in one task.
    """
    distinct = long.select(variable, member).where(F.col(member).isNotNull()).distinct()
    salted = distinct.withColumn("_salt", F.pmod(F.hash(member), F.lit(salt_buckets)))
    w1 = Window.partitionBy(variable, "_salt").orderBy(member)
    cand = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(variable).orderBy(member)
    top = cand.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= k)
    return top.groupBy(variable).agg(
        F.array_join(F.array_sort(F.collect_list(member)), ",").alias("first_members"))


def with_position(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """O1, O2: ``df`` sorted, each row with its place (from 1) in the sorted result.

    The sort is Spark's range sort over all partitions, written once; the place follows from the
    file's numbers (of the sorted part and, where a record limit splits it, of the file within),
    the rows in the files before it (one count per file) and the row's number within it.  No task sees more than its range, as a window without partitions would."""
    path = work_path(df.sparkSession, "sorted")
    df.orderBy(*order).write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    number = lambda pattern: F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).cast("int")
    rows = rows.select("*", F.struct(number(r"^part-([0-9]+)").alias("part"), number(r"-c([0-9]+)[.]").alias("split")).alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)   # a row per file
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(sizes), "_file").withColumn(name, F.col("_before") + F.col("_row") + 1)
            .drop("_file", "_row", "_before"))
