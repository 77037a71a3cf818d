"""Data-quality checks (Q1-Q6).  Each check returns its failing rows as a DataFrame; a suite
returns one result row per check.  All checks are aggregations (partial + final), so a check
over a huge table shuffles only per-key counts, never the rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q1: values occurring more than once (NULLs are not_null's business)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows where the column is NULL."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q2 batched: NULL count of many columns in one pass, one row per column."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stacked = counts.unpivot([], columns, "column_name", "failures")
    return stacked.select("column_name", F.col("failures").cast("bigint").alias("failures"))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Q3: rows whose value is outside the list (NULL passes)."""
    return df.where(~F.col(column).isin(list(values)))


def between(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Q4: rows outside the inclusive range; either bound optional; NULL passes."""
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return df.where(bad)


def freshness(sources: dict[str, DataFrame | datetime | None], limits: dict[str, tuple[int, int]], as_of,
              loaded_at: str = "_LOADED_AT") -> DataFrame:
    """Q5: per source the newest load time, its age in hours at ``as_of`` and the status
    (``pass`` / ``warn`` / ``error`` against warn/error limits in days).  A source is a frame, which is
    read, or its newest load time where that is known (:func:`keyfig.operators.changes.newest`)."""
    parts = []
    for name, df in sources.items():
        warn_d, error_d = limits[name]
        newest = (df.agg(F.max(loaded_at).alias("max_loaded_at")) if isinstance(df, DataFrame)
                  else SparkSession.active().range(1).select(F.lit(df).cast("timestamp_ntz").alias("max_loaded_at")))
        parts.append(newest.select(
            F.lit(name).alias("source_name"), "max_loaded_at",
            F.lit(warn_d).alias("warn_after_days"), F.lit(error_d).alias("error_after_days")))
    t = reduce(DataFrame.unionByName, parts)
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    age_h = F.timestamp_diff("HOUR", F.col("max_loaded_at"), as_of_ts)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age_h > F.col("error_after_days") * 24, F.lit("error"))
              .when(age_h > F.col("warn_after_days") * 24, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return t.select("source_name", "max_loaded_at", age_h.cast("bigint").alias("age_hours"),
                    "warn_after_days", "error_after_days", status.alias("status"))


@dataclass(frozen=True)
class Check:
    kind: str              # unique | not_null | accepted_values | between
    model: str
    column: str
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None

    def failing_rows(self, df: DataFrame) -> DataFrame:
        if self.kind == "unique":
            return unique(df, self.column)
        if self.kind == "not_null":
            return not_null(df, self.column)
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, list(self.values))
        if self.kind == "between":
            return between(df, self.column, self.min_value, self.max_value)
        raise ValueError(self.kind)


RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()), T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType())])


def _bad(c: Check):
    col = F.col(c.column)
    if c.kind == "not_null":
        bad = col.isNull()
    elif c.kind == "accepted_values":
        bad = ~col.isin(list(c.values))
    elif c.kind == "between":
        bad = F.lit(False)
        if c.min_value is not None:
            bad = bad | (col < F.lit(c.min_value))
        if c.max_value is not None:
            bad = bad | (col > F.lit(c.max_value))
    else:
        raise ValueError(c.kind)
    return F.coalesce(bad, F.lit(False))


def _model_results(model: str, df: DataFrame, cs: list[Check]) -> DataFrame:
    """All checks of one model in one scan of it.  With a ``unique`` check the rows are grouped
    by that column once (partial aggregation, per-key counts only are shuffled) and the row
    checks ride along as per-group failure counts, summed in the second step."""
    uniques = [c for c in cs if c.kind == "unique"]
    rows = [c for c in cs if c.kind != "unique"]
    first_unique = uniques[0] if uniques else None
    if first_unique is not None:
        key = F.col(first_unique.column)
        per_key = df.groupBy(key.alias("_k")).agg(
            F.count(F.lit(1)).alias("_n"), *[F.count_if(_bad(c)).alias(f"r{i}") for i, c in enumerate(rows)])
        totals = per_key.agg(F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("u0"),
                             *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rows))])
    else:
        totals = df.agg(*[F.count_if(_bad(c)).alias(f"r{i}") for i, c in enumerate(rows)])
    named = [(first_unique, "u0")] if first_unique is not None else []
    named += [(c, f"r{i}") for i, c in enumerate(rows)]
    stacked = totals.select(F.explode(F.array(*[
        F.struct(F.lit(c.kind).alias("check_name"), F.lit(model).alias("model"),
                 F.lit(c.column).alias("column_name"),
                 F.coalesce(F.col(alias), F.lit(0)).cast("bigint").alias("failures"))
        for c, alias in named])).alias("r")).select("r.*")
    for extra in uniques[1:]:
        stacked = stacked.unionByName(unique(df, extra.column).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("unique").alias("check_name"), F.lit(model).alias("model"),
            F.lit(extra.column).alias("column_name"), F.col("failures").cast("bigint")))
    return stacked


def run_checks(spark: SparkSession, models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Q6: evaluate many checks, one result row (check, model, column, failures, status) each.
    Every model is read by a single aggregation pipeline however many checks it has."""
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    parts = [_model_results(m, models[m], cs) for m, cs in by_model.items()]
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    res = reduce(DataFrame.unionByName, parts)
    return res.withColumn("status", F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")))


def gate(results: DataFrame) -> None:
    """Q6: stop dependants when any check failed (raises with the failing checks)."""
    failed = results.where(F.col("status") == "fail").limit(20).collect()
    if failed:
        raise RuntimeError("quality gate failed: " + "; ".join(
            f"{r['check_name']}({r['model']}.{r['column_name']})={r['failures']}" for r in failed))
