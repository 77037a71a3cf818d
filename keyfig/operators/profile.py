"""Dimension profiling of a long-format extract (A10, A11) and the metadata document.

Column-wise statistics are computed by stacking the dimension columns into (variable, member)
pairs first: one distinct + one group-by over a narrow frame, independent of how many columns
the extract has, instead of one COUNT(DISTINCT) per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.operators.changes import append_load, read_loads
from keyfig.operators.windows import first_k_members

# Cell-count warning threshold of the exploration tool, and the API ceiling.
WARN_CELLS = 500_000
MAX_CELLS = 1_000_000


def stack_members(df: DataFrame, dims: list[str], time_col: str | None = None) -> DataFrame:
    """(variable, member, is_time) for every dimension value of every row."""
    pairs = F.array(*[F.struct(F.lit(d).alias("variable"), F.col(d).cast("string").alias("member"))
                      for d in dims])
    out = df.select(F.inline(pairs))
    return out.withColumn("is_time", F.col("variable") == F.lit(time_col) if time_col
                          else F.lit(False))


def dimension_profile(df: DataFrame, dims: list[str], time_col: str | None = None,
                      eliminable: tuple[str, ...] = (), k: int = 5) -> DataFrame:
    """A10: per variable the number of distinct members, its first ``k`` members (sorted),
    whether it is the time variable and whether it may be eliminated."""
    long = stack_members(df, dims, time_col)
    counts = (long.select("variable", "member").where(F.col("member").isNotNull()).distinct()
              .groupBy("variable").agg(F.count(F.lit(1)).alias("n_values")))
    firsts = first_k_members(long, "variable", "member", k)
    return (counts.join(firsts, "variable", "left")
            .select("variable", "n_values", F.col("first_members").alias("sample_values"),
                    (F.col("variable") == F.lit(time_col or "")).alias("is_time"),
                    F.col("variable").isin(list(eliminable) or [""]).alias("eliminable")))


#: Registers of a distinct-count sketch as a power of two: a standard error of 0.8 %, 16 KB a variable.
SKETCH_POWER = 14
_SKETCHES = T.StructType([T.StructField("sketch", T.BinaryType()), T.StructField("n_rows", T.LongType()), T.StructField("variable", T.StringType())])


def profile_load(df: DataFrame, dims: list[str], base: str, load: str, power: int = SKETCH_POWER) -> int:
    """A10, mergeable: keeps one distinct-count sketch per variable of a load, once per load name.
    Only the load is read; earlier ones are in their sketches."""
    long = stack_members(df, dims)
    rows = long.groupBy("variable").agg(F.hll_sketch_agg("member", F.lit(power)).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))
    return append_load(rows.select(*_SKETCHES.fieldNames()), base, load, "variable")


def profile_estimate(spark: SparkSession, base: str, loads: list[str] | None = None) -> DataFrame:
    """The number of distinct members per variable over all (or some) loads, from their sketches:
    an estimate beside :func:`dimension_profile`, which counts exactly and reads everything."""
    kept = read_loads(spark, base, _SKETCHES, "variable", loads)
    return kept.groupBy("variable").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_values_estimate"), F.sum("n_rows").alias("n_rows"))


def estimate_cells(profile: DataFrame, selected: dict[str, int] | None = None) -> DataFrame:
    """rows = product over variables of the selected member count (all members unless a
    smaller selection is given; each factor at least 1); cells = rows x (variables + 1)."""
    selected = selected or {}
    factor = F.col("n_values")
    for var, n in selected.items():
        factor = F.when(F.col("variable") == F.lit(var), F.least(F.col("n_values"), F.lit(n))).otherwise(factor)
    per = profile.select(F.greatest(factor, F.lit(1)).cast("bigint").alias("f"))
    agg = per.agg(F.count(F.lit(1)).alias("n_vars"),
                  F.aggregate(F.collect_list("f"), F.lit(1).cast("bigint"), lambda acc, x: acc * x)
                  .alias("n_rows"))
    cells = F.when(F.col("n_vars") == 0, F.lit(0)).otherwise(F.col("n_rows") * (F.col("n_vars") + 1))
    return agg.select("n_vars", "n_rows", cells.cast("bigint").alias("n_cells"),
                      (cells > WARN_CELLS).alias("above_warn"), (cells > MAX_CELLS).alias("above_limit"))


def metadata_document(df: DataFrame, dims: list[str], time_col: str | None = None, buckets: int = 64) -> DataFrame:
    """S15 writer side: rows of ``{id, text, time, values[].{id, text}}`` (the layout of the
    statistics API's table metadata).  At every size a variable is one to ``buckets`` rows, each
    with the members of one hash bucket, so no row or task holds all members of a large variable;
    readers unite the rows of a variable."""
    long = stack_members(df, dims, time_col).where(F.col("member").isNotNull()).distinct()
    return long.groupBy("variable", "is_time", F.pmod(F.hash("member"), F.lit(buckets)).alias("_bucket")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("member").alias("id"), F.col("member").alias("text"))))
        .alias("values")).select(F.col("variable").alias("id"), F.col("variable").alias("text"),
                                 F.col("is_time").alias("time"), "values")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """S15 reader side: the documents in one pass, as declared paths of a variant and the whole
    variant (``document``), which keeps fields that nobody declared.  Nothing is inferred."""
    doc = spark.read.text(path).select(F.parse_json("value").alias("document"))
    get = lambda p, kind: F.variant_get("document", p, kind)
    return doc.select(get("$.id", "string").alias("id"), get("$.text", "string").alias("text"), get("$.time", "boolean").alias("time"),
                      get("$.values", "array<struct<id string, text string>>").alias("values"), "document")


def variable_members(metadata: DataFrame, variable: str) -> DataFrame:
    """S15 reader side: member ids of one variable, matched case-insensitively; an unknown
    variable is an error."""
    hit = metadata.where(F.upper(F.col("id")) == F.lit(variable.upper()))
    if hit.limit(1).count() == 0:
        raise ValueError(f"variable {variable!r} not found")
    return hit.select(F.explode("values").alias("v")).select(F.col("v.id").alias("id"),
                                                             F.col("v.text").alias("text"))
