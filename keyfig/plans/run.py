"""The daily pipeline in explicit order (what the original's orchestrator ran as two processes):
land new extracts -> staging checks -> dimension -> incremental facts -> marts -> history.

Each layer is checked *before* it replaces its published version: a failed check stops the run
with the previous facts, dimension and history still current.  Timing is left to whoever submits
the job."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.operators import changes, history, incremental, partitions, quality
from keyfig.operators.joins import anti_join
from keyfig.plans import core, marts, refresh, staging
from keyfig.plans.checks import suite
from keyfig.plans.config import (RAW_HOUSING_NATIONAL, RAW_LOCAL_INCOME, RAW_PRICE_INDEX,
                                 RAW_PRICE_REGIONAL, RAW_SPECS, RAW_UNEMPLOYMENT, PipelineConfig, RawSpec)
from keyfig.plans.state import LabourState
from keyfig.session import work_path
from keyfig.sources.sink import list_dir, path_exists


@dataclass
class PipelineRun:
    raw_rows_landed: dict[str, int]
    dim_municipalities: DataFrame
    fct_housing_prices: DataFrame
    fct_labour_market_regional: DataFrame
    mart_housing_affordability: DataFrame
    mart_labour_housing_correlation: DataFrame
    checks: DataFrame
    municipality_history: DataFrame


def raw_schema(spec: RawSpec) -> T.StructType:
    return T.StructType([*(T.StructField(c, T.StringType()) for c in spec.columns),
                         T.StructField(spec.loaded_at, T.TimestampNTZType()),
                         T.StructField(spec.src_table, T.StringType())])


#: Stands for the rows of a raw folder that were written there without a manifest.
PLAIN = ""


def _is_plain(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path) and any("=" in name for name in list_dir(spark, path))


def raw_loads(spark: SparkSession, warehouse: str, spec: RawSpec) -> list[str]:
    """The names of a source's loads."""
    path = f"{warehouse}/raw/{spec.name}"
    return [PLAIN] * _is_plain(spark, path) + list(changes.Store(spark, path).state()["loads"])


def read_raw(spark: SparkSession, warehouse: str, spec: RawSpec, loads: list[str] | None = None) -> DataFrame:
    """The raw history of a source, or some loads of it, partitioned by period; empty if it never
    was landed.  The schema is given, so periods stay the text they were delivered as."""
    path = f"{warehouse}/raw/{spec.name}"
    named = changes.read_loads(spark, path, raw_schema(spec), spec.period, loads and [n for n in loads if n != PLAIN])
    if (loads is None or PLAIN in loads) and _is_plain(spark, path):
        folders = [f"{path}/{name}" for name in list_dir(spark, path) if "=" in name]
        plain = spark.read.schema(raw_schema(spec)).option("basePath", path).parquet(*folders)
        return plain if not changes.Store(spark, path).versions() else named.unionByName(plain)
    return named


def source_freshness(spark: SparkSession, warehouse: str, cfg: PipelineConfig, as_of) -> DataFrame:
    """Q5 over the raw histories, from the manifests of their loads: no data is read."""
    known = {s.name: changes.newest(spark, f"{warehouse.rstrip('/')}/raw/{s.name}", s.loaded_at) for s in RAW_SPECS}
    return quality.freshness({n: t for n, t in known.items() if n in cfg.freshness}, cfg.freshness, as_of)


def unmatched_names(staged: dict[str, tuple[DataFrame, str]], dim: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """J7 as a result row per model: names that no member, region or total of the dimension has.
    They fall out of the inner join, so they are told here (status ``warn``)."""
    known = reduce(DataFrame.unionByName, [
        dim.select(F.col("municipality_name").alias("_name")), dim.select(F.col("region_name").alias("_name")),
        dim.sparkSession.createDataFrame([(cfg.total_area,)], "_name string")]).distinct()
    parts = []
    for model, (df, column) in staged.items():
        lost = anti_join(df.select(F.col(column).alias("_name")).distinct(), known, "_name")
        parts.append(lost.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("unmatched_names").alias("check_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
            "failures", F.when(F.col("failures") > 0, "warn").otherwise("pass").alias("status")))
    return reduce(DataFrame.unionByName, parts)


def run_pipeline(spark: SparkSession, new_extracts: dict[str, DataFrame], seed: DataFrame,
                 warehouse: str, cfg: PipelineConfig, snapshot_ts,
                 accepted_regions: tuple[str, ...] | None = None, gate: bool = True,
                 load: str | None = None, keep_versions: int = 30) -> PipelineRun:
    """One run.  ``new_extracts`` are this run's landed raw loads (stamped with their load time);
    a source that failed to land is simply not among them.  They are appended to the raw history,
    which is partitioned by period, as loads named ``load`` (the snapshot time unless given): each
    is there as a whole or not at all, and once, however often the run is repeated.  A ledger of
    applied loads per source tells what the facts do not contain yet -- this run's loads, late
    ones, and those of a run that failed its checks.  These are read, no others: the labour fact is
    a state that they are applied to, and of the housing fact the cells that they touch change.
    Versions beyond the ``keep_versions`` newest are deleted at the end."""
    wh, load, keep_versions = warehouse.rstrip("/"), load or str(snapshot_ts), max(keep_versions, 2)
    accepted_regions = accepted_regions or tuple(cfg.region_local_names)
    checks = suite(cfg, accepted_regions)
    results: list[DataFrame] = []

    def passed(models: dict[str, DataFrame]) -> None:
        """Checks a layer; its results are stored once, the gate reads them."""
        found = quality.run_checks(spark, models, [c for c in checks if c.model in models])
        results.append(incremental.publish(found, work_path(spark, "checks")))
        if gate:
            quality.gate(results[-1])

    landed = {}
    for spec in RAW_SPECS:
        if spec.name in new_extracts:
            landed[spec.name] = changes.append_load(new_extracts[spec.name], f"{wh}/raw/{spec.name}", load, spec.period, [spec.loaded_at])
    raw = {s.name: read_raw(spark, wh, s) for s in RAW_SPECS}

    staged = {"src_price_index": staging.src_price_index(raw[RAW_PRICE_INDEX.name], cfg),
              "src_price_regional": staging.src_price_regional(raw[RAW_PRICE_REGIONAL.name], cfg),
              "src_unemployment": staging.src_unemployment(raw[RAW_UNEMPLOYMENT.name], cfg),
              "src_local_income": staging.src_local_income(raw[RAW_LOCAL_INCOME.name], cfg),
              "src_housing_national": staging.src_housing_national(raw[RAW_HOUSING_NATIONAL.name], cfg)}
    passed({"seed": seed, **staged})

    dim_new = incremental.publish(core.dim_municipalities(seed, cfg), work_path(spark, "dim"))
    passed({"dim_municipalities": dim_new})
    dim = incremental.publish(dim_new, f"{wh}/dim_municipalities")
    results.append(unmatched_names({"src_unemployment": (staged["src_unemployment"], "area_name"),
                                    "src_local_income": (staged["src_local_income"], "municipality_name")}, dim, cfg))

    # facts: the change of each is staged, checked and only then made visible
    ledger = changes.Store(spark, f"{wh}/applied_loads")
    done = ledger.state()["notes"]
    names = {s.name: raw_loads(spark, wh, s) for s in RAW_SPECS}

    def fresh(spec: RawSpec, anew: bool) -> DataFrame:
        """The loads that a fact lacks; all of them for a new fact."""
        return raw[spec.name] if anew else read_raw(spark, wh, spec, [n for n in names[spec.name] if n not in done.get(spec.name, [])])

    hp_store, hp_keys = changes.Store(spark, f"{wh}/fct_housing_prices"), refresh.HOUSING_KEYS
    hp_schema = core.fct_housing_prices(staged["src_price_index"], dim, cfg).schema
    if hp_store.versions():
        hp_rows, hp_gone = refresh.housing_change(raw[RAW_PRICE_INDEX.name], fresh(RAW_PRICE_INDEX, False), dim, cfg)
    else:
        hp_rows, hp_gone = core.fct_housing_prices(staged["src_price_index"], dim, cfg), None
    hp_change = hp_store.stage(hp_rows, "rows", refresh.PARTITION, hp_keys, gone=hp_gone)

    lab_base = f"{wh}/fct_labour_market_regional"
    lab_schema = core.fct_labour_market_regional(staged["src_unemployment"], staged["src_local_income"], dim).schema
    if cfg.resolve == "latest":
        state = LabourState(spark, f"{wh}/labour_state", dim, cfg)
        anew = not state.store.versions()
        applied = state.apply(fresh(RAW_UNEMPLOYMENT, anew), fresh(RAW_LOCAL_INCOME, anew))
        change = refresh.Change(state.fact(applied, applied.years).select(*lab_schema.fieldNames()), applied.years)
    else:  # values of all loads count: no state of newest ones
        anew = not incremental.committed_versions(spark, lab_base)
        now = None if anew else partitions.read(spark, lab_base, lab_schema, refresh.PARTITION)
        change = refresh.refresh_labour(now, raw[RAW_UNEMPLOYMENT.name], raw[RAW_LOCAL_INCOME.name],
                                        fresh(RAW_UNEMPLOYMENT, anew), fresh(RAW_LOCAL_INCOME, anew), dim, cfg)
    lab_rows = incremental.publish(change.rows, work_path(spark, "change"))
    passed({"fct_housing_prices": hp_store.staged(hp_change, hp_schema, hp_keys), "fct_labour_market_regional": lab_rows})
    hp_store.commit([hp_change])
    if cfg.resolve == "latest":
        state.commit(applied)
    if change.years:
        partitions.replace(lab_rows, lab_base, refresh.PARTITION, change.years)
    ledger.commit([], notes=names)
    hp = hp_store.read("rows", hp_schema, refresh.PARTITION, hp_keys)
    lab = partitions.read(spark, lab_base, lab_schema, refresh.PARTITION)

    # marts are views over the published facts
    mart = marts.mart_housing_affordability(hp, lab, staged["src_price_regional"])
    corr = marts.mart_labour_housing_correlation(mart, cfg)
    passed({"mart_housing_affordability": mart, "mart_labour_housing_correlation": corr})
    mart.createOrReplaceTempView("mart_housing_affordability")
    corr.createOrReplaceTempView("mart_labour_housing_correlation")

    hist_base = f"{wh}/scd_municipalities"
    members = dim.select("municipality_code", "municipality_name", "region_code", "region_name")
    kept = history.History(spark, hist_base, "municipality_code", ["municipality_name", "region_code", "region_name"])
    earlier = incremental.read_current(spark, hist_base)
    if earlier is not None and not kept.store.versions():
        kept.adopt(earlier)
    kept.take(members, snapshot_ts)
    hist = kept.read()

    # upkeep: changes that have grown many are written anew, what no recent version shows goes
    hp_store.compact("rows", hp_schema, refresh.PARTITION, hp_keys)
    if cfg.resolve == "latest":
        state.compact()
        state.store.vacuum(keep_versions)
    for store in (hp_store, ledger, kept.store):
        store.vacuum(keep_versions)
    incremental.retire(spark, f"{wh}/dim_municipalities", keep_versions)
    hp = hp_store.read("rows", hp_schema, refresh.PARTITION, hp_keys)
    return PipelineRun(landed, dim, hp, lab, mart, corr, reduce(DataFrame.unionByName, results), hist)


def full_rebuild(raw: dict[str, DataFrame], seed: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The mart from scratch over the whole raw history (what incremental runs must equal)."""
    dim = core.dim_municipalities(seed, cfg)
    hp = core.fct_housing_prices(staging.src_price_index(raw[RAW_PRICE_INDEX.name], cfg), dim, cfg)
    lab = core.fct_labour_market_regional(staging.src_unemployment(raw[RAW_UNEMPLOYMENT.name], cfg),
                                          staging.src_local_income(raw[RAW_LOCAL_INCOME.name], cfg), dim)
    mart = marts.mart_housing_affordability(hp, lab, staging.src_price_regional(raw[RAW_PRICE_REGIONAL.name], cfg))
    return marts.mart_labour_housing_correlation(mart, cfg)
