"""The labour fact as a state that loads are applied to as signed deltas.

Two tables of one store (:mod:`keyfig.operators.changes`).  ``cells`` has the newest value of every
child, period and source.  ``measures`` has, per (region, year), additive rows: for every load
instant the number of cells that stand by it and their exact sum, values too large for exact
decimals by themselves with their number, and the number of children with a value.  A load changes
some cells; what the cells of a touched (child, year) contributed is written with a minus, what
they contribute now with a plus, and both tables become visible by one manifest entry.  Sums of
these rows are the group's state, so no group is rebuilt from its children and the raw history is
not read: a load reads the buckets of the cells that it touches and writes rows in proportion to
itself.  A newest value that is suppressed takes its cell's contribution away.

Loads may come in any order: a cell is of its newest load.  The regions of the children are noted
with the state; when they change, the measures are made anew from the cells.  A load that is applied
twice changes nothing.  Keys, years and values follow the staging models.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.functions.columns import strict_int, surrogate_key
from keyfig.operators.changes import Store
from keyfig.operators.reshape import latest_value
from keyfig.plans.config import RAW_LOCAL_INCOME, RAW_UNEMPLOYMENT, PipelineConfig
from keyfig.plans.staging import _value as metric_value

YEAR = "period_year"
CELL_KEYS = ["source", "child", "tid", YEAR]


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


CELLS = _schema(source=T.StringType(), child=T.StringType(), tid=T.StringType(), period_year=T.IntegerType(), value=T.DoubleType(), loaded_at=T.TimestampNTZType())
MEASURES = _schema(source=T.StringType(), region_name=T.StringType(), loaded_at=T.TimestampNTZType(), large=T.DoubleType(), n=T.LongType(),
                   total=T.DecimalType(38, 12), areas=T.LongType(), period_year=T.IntegerType())
UNEMPLOYMENT, INCOME = "unemployment", "income"
#: Above this, a double has no exact decimal with 12 places.
_LARGE = 1e15
#: Rows, whether they are distinct, and digest of dimensions by plan; a published dimension is an immutable version.
_REGIONS: dict[tuple, tuple[int, bool, str]] = {}
#: Members of a dimension up to which it is broadcast.
BROADCAST_ROWS = 100_000


class Applied(NamedTuple):
    """Staged changes of one or more loads; ``years`` are the periods that they touch."""

    cells: dict | None
    measures: dict
    years: list[int]
    notes: dict


def cells_of(unemployment: DataFrame, income: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The newest value per source, child and period of some raw rows, suppressed ones included."""
    u, i = RAW_UNEMPLOYMENT, RAW_LOCAL_INCOME
    rows = (unemployment.where(F.col("YDELSESTYPE") == F.lit(cfg.unemployment_type))
            .select(F.lit(UNEMPLOYMENT).alias("source"), F.col("OMRÅDE").alias("child"), F.col(u.period).alias("tid"),
                    metric_value(u, cfg).alias("value"), F.col(u.loaded_at).alias("loaded_at"))
            .unionByName(income.where((F.col("ENHED") == F.lit(cfg.income_unit)) & (F.col("INDKOMSTTYPE") == F.lit(cfg.income_type)))
                         .select(F.lit(INCOME).alias("source"), F.col("OMRÅDE").alias("child"), F.col(i.period).alias("tid"),
                                 metric_value(i, cfg).alias("value"), F.col(i.loaded_at).alias("loaded_at"))))
    return latest_value(rows, ["source", "child", "tid"], "value", "loaded_at").withColumn(YEAR, strict_int("tid", "period year")).select(*CELLS.fieldNames())


def _measures(before: DataFrame | None, after: DataFrame, members: DataFrame) -> DataFrame:
    """The signed measures of a change: what the cells of ``after`` contribute, less what they did.

    ``before`` has earlier rows of these cells and of others of their children.  ``members`` has the
    regions of each child and how often."""
    rows = after.selectExpr("*", "true AS new")
    if before is not None:
        rows = rows.unionByName(before.selectExpr("*", "false AS new"))
    # dealt once, by child and year: cells are summed up below that, children at it
    cells = rows.repartition("source", "child", YEAR).groupBy("source", "child", YEAR, "tid").agg(*map(F.expr, (
        "max(new) AS touched", "max_by(value, loaded_at) AS v1", "max(loaded_at) AS t1",
        "max_by(value, loaded_at) FILTER (WHERE NOT new) AS v0", "max(loaded_at) FILTER (WHERE NOT new) AS t0")))
    sums = (cells.where("touched")
            .selectExpr("source", "child", YEAR, "inline(array(struct(-1 AS sign, v0 AS v, t0 AS loaded_at), struct(1 AS sign, v1 AS v, t1 AS loaded_at)))")
            .where("v IS NOT NULL")
            .selectExpr("source", "child", YEAR, "loaded_at", f"if(abs(v) >= {_LARGE}, v, null) AS large", "sign AS n",
                        f"CAST(if(abs(v) >= {_LARGE}, null, sign * CAST(v AS decimal(38,12))) AS decimal(38,12)) AS total", "0 AS areas"))
    children = (cells.groupBy("source", "child", YEAR).agg(F.expr("max(touched) AS touched"), F.expr("CAST(bool_or(v1 IS NOT NULL) AS int) - CAST(bool_or(v0 IS NOT NULL) AS int) AS areas"))
                .where("touched AND areas <> 0")
                .selectExpr("source", "child", YEAR, "CAST(null AS timestamp_ntz) AS loaded_at", "CAST(null AS double) AS large", "0 AS n",
                            "CAST(null AS decimal(38,12)) AS total", "areas"))
    net = sums.unionByName(children).join(members, F.expr("child = _child")).groupBy("source", "_region", "loaded_at", "large", YEAR).agg(*map(F.expr, (
        "sum(n * _times) AS n", "sum(CAST(total * _times AS decimal(38,12))) AS total", "sum(areas) AS areas")))
    return (net.where("n <> 0 OR coalesce(total, 0) <> 0 OR areas <> 0")
            .selectExpr("source", "_region AS region_name", "loaded_at", "large", "CAST(n AS bigint) AS n", "CAST(total AS decimal(38,12)) AS total", "CAST(areas AS bigint) AS areas", YEAR))


class LabourState:
    """The state below ``base``, for the regions of ``dim``."""

    def __init__(self, spark: SparkSession, base: str, dim: DataFrame, cfg: PipelineConfig, buckets: int = 4):
        if cfg.resolve != "latest":
            raise ValueError("the state keeps the newest load of a cell; other modes are rebuilt")
        self.store, self.dim, self.cfg, self.buckets = Store(spark, base), dim, cfg, buckets

    def _members(self) -> tuple[DataFrame, str]:
        """Regions per child, and a digest of them; broadcast once they are counted to be few."""
        key = (self.dim.sparkSession.sparkContext.applicationId, self.dim.semanticHash())
        if key not in _REGIONS:
            pair = "xxhash64(municipality_name, region_name)"
            n, once, *sums = self.dim.selectExpr("count(1)", f"count(DISTINCT {pair}) = count(1)", f"bit_xor({pair})", f"sum(shiftright({pair}, 20))").first()
            _REGIONS[key] = n, once, "|".join(map(str, [n, *sums]))
        n, once, digest = _REGIONS[key]
        members = self.dim.where("region_name IS NOT NULL").selectExpr("municipality_name AS _child", "region_name AS _region", "1 AS _times")
        if not once:
            members = members.groupBy("_child", "_region").agg(F.expr("count(1) AS _times"))
        return (F.broadcast(members) if n <= BROADCAST_ROWS else members), digest

    def apply(self, unemployment: DataFrame, income: DataFrame) -> Applied:
        """Stages the change that some raw rows make; nothing is visible until :meth:`commit`."""
        store, state = self.store, self.store.state()
        if state["version"] and state["notes"]["buckets"] != self.buckets:
            raise ValueError(f"the state has {state['notes']['buckets']} buckets")
        cells = store.stage(cells_of(unemployment, income, self.cfg), "cells", YEAR, CELL_KEYS, self.buckets, hashed=["child"])
        members, regions = self._members()
        notes = {"regions": regions, "buckets": self.buckets}
        years = [int(p.partition("=")[2]) for p in cells["parts"] if not p.endswith("__HIVE_DEFAULT_PARTITION__")]
        if state["version"] and state["notes"]["regions"] != regions:
            # children have moved: all measures anew, from the cells
            now = store.read("cells", CELLS, YEAR, CELL_KEYS, ["loaded_at"], pending=cells)
            held = state["tables"].get("measures", {})
            measures = store.stage(_measures(None, now, members), "measures", YEAR, full=True, replaced={p: list(b) for p, b in held.items()}, spread=False)
            years = sorted({int(p.partition("=")[2]) for p in [*held, *measures["parts"]] if not p.endswith("__HIVE_DEFAULT_PARTITION__")} | set(years))
            return Applied(cells, measures, years, notes)
        touched = sorted({int(b) for held in cells["parts"].values() for b in held})
        before = store.rows("cells", CELLS, YEAR, CELL_KEYS, [*years, None], touched) if state["version"] else None
        measures = store.stage(_measures(before, store.staged(cells, CELLS, CELL_KEYS), members), "measures", YEAR, spread=False)
        return Applied(cells, measures, sorted(years), notes)

    def fact(self, pending: Applied | None = None, years: list[int] | None = None) -> DataFrame:
        """The labour fact (M8), of all or some years, with a staged change as if it were committed."""
        rows = self.store.read("measures", MEASURES, YEAR, values=years, pending=pending.measures if pending else None)
        net = rows.groupBy("region_name", YEAR, "source", "loaded_at", "large").agg(F.expr("sum(n) AS n"), F.expr("sum(total) AS total"), F.expr("sum(areas) AS areas"))
        aggs = []
        for source, p in ((UNEMPLOYMENT, "u"), (INCOME, "i")):
            own = f"FILTER (WHERE source = '{source}')"
            big = f"FILTER (WHERE source = '{source}' AND large IS NOT NULL AND n > 0)"
            exact = f"CAST(sum(total) {own} AS double)"
            aggs += [f"if(count(1) {big} > 0, coalesce({exact}, 0) + sum(large * n) {big}, {exact}) AS {p}_total", f"sum(n) {own} AS {p}_n",
                     f"coalesce(sum(areas) {own}, 0) AS {p}_areas", f"max(loaded_at) FILTER (WHERE source = '{source}' AND n > 0) AS {p}_loaded"]
        return (net.groupBy("region_name", YEAR).agg(*map(F.expr, aggs)).where("u_areas > 0 OR i_areas > 0")
                .select(surrogate_key("region_name", YEAR).alias("labour_regional_id"), "region_name", YEAR, *map(F.expr, (
                    "if(u_areas > 0, u_total, null) AS total_gross_unemployment", "if(i_areas > 0, i_total / i_n, null) AS avg_disposable_income_dkk",
                    "if(u_areas > 0, u_areas, i_areas) AS municipality_count", "greatest(u_loaded, i_loaded) AS _loaded_at"))))

    def commit(self, applied: Applied, load: str | None = None) -> int:
        return self.store.commit([c for c in (applied.cells, applied.measures) if c], load=load, notes=applied.notes)

    def compact(self, changes: int = 8) -> int:
        """Folds cells with many changes, and partitions of measures into their sums."""
        done = self.store.compact("cells", CELLS, YEAR, CELL_KEYS, ["loaded_at"], self.buckets, changes, hashed=["child"])
        parts = self.store.live("measures")
        due = {p: list(b) for p, b in parts.items() if any(len(c) > changes for c in b.values())}
        if due:
            years = [None if p.endswith("__HIVE_DEFAULT_PARTITION__") else int(p.partition("=")[2]) for p in due]
            rows = self.store.read("measures", MEASURES, YEAR, values=years)
            sums = rows.groupBy("source", "region_name", "loaded_at", "large", YEAR).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,12)").alias("total"), F.sum("areas").alias("areas"))
            self.store.commit([self.store.stage(sums.select(*MEASURES.fieldNames()), "measures", YEAR, full=True, replaced=due)])
        return done + sum(map(len, due.values()))
