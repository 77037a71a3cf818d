"""Tables replaced partition by partition: typing, commits, merges, and the facts kept on them."""

import random
import re

import pytest
from fixtures import CFG, GROSS, KIND, SEED, UNIT, raw_frame, seed_frame
from pyspark.sql import functions as F

from keyfig.operators import partitions as P
from keyfig.operators.history import snapshot
from keyfig.operators.incremental import committed_versions, loads, not_applied
from keyfig.plans import core, refresh, staging

SCHEMA = "k string, v int, t string"


def table(spark, base):
    df = spark.createDataFrame([], SCHEMA)
    return sorted(map(tuple, P.read(spark, base, df.schema, "t").collect()))


def test_periods_stay_text_and_formats_mix(spark, tmp_path):
    base = str(tmp_path / "t")
    batches = [[("a", 1, "01")], [("a", 2, "01"), ("b", 1, "1")], [("a", 3, "2024Q1"), ("a", 4, "2023")], [("c", 1, "2024Q1"), ("d", 9, None)]]
    for rows in batches:
        P.merge_latest(spark, base, spark.createDataFrame(rows, SCHEMA), ["k", "t"], ["v"], "t")
    want = [("a", 2, "01"), ("a", 3, "2024Q1"), ("a", 4, "2023"), ("b", 1, "1"), ("c", 1, "2024Q1"), ("d", 9, None)]
    assert sorted(table(spark, base), key=str) == sorted(want, key=str)
    # a replay, or an older load that comes late, changes nothing
    P.merge_latest(spark, base, spark.createDataFrame([("a", 1, "01"), ("a", 4, "2023")], SCHEMA), ["k", "t"], ["v"], "t")
    assert sorted(table(spark, base), key=str) == sorted(want, key=str)


def test_a_dead_attempt_is_passed_over(spark, tmp_path):
    base = tmp_path / "t"
    (base / "_version=1" / "t=x").mkdir(parents=True)   # died after making folders
    assert table(spark, str(base)) == []
    P.merge_latest(spark, str(base), spark.createDataFrame([("a", 1, "x")], SCHEMA), ["k", "t"], ["v"], "t")
    assert table(spark, str(base)) == [("a", 1, "x")]
    (base / "_version=2" / "t=x").mkdir(parents=True)
    (base / "_version=2" / "t=x" / "part-0.parquet").write_bytes(b"cut off")
    assert table(spark, str(base)) == [("a", 1, "x")]
    P.replace(spark.createDataFrame([("b", 2, "y")], SCHEMA), str(base), "t", ["x", "y"])   # x becomes empty
    assert table(spark, str(base)) == [("b", 2, "y")]
    assert committed_versions(spark, str(base)) == [1, 2]


def _labour(spark, order, tmp_path, seed):
    """Loads applied in the given order (a load is one source's rows); the fact read back."""
    dim = core.dim_municipalities(seed_frame(spark), CFG, with_load_time=False)
    base, ledger, seen = str(tmp_path / f"f{seed}"), None, {"RAW_UNEMPLOYMENT": [], "RAW_LOCAL_INCOME": []}
    target = None
    for name, frame in order:
        seen[name].append(frame)
        raw = {n: _all(spark, n, frames) for n, frames in seen.items()}
        new = {n: not_applied(df, n, ledger) for n, df in raw.items()}
        change = refresh.refresh_labour(target, raw["RAW_UNEMPLOYMENT"], raw["RAW_LOCAL_INCOME"],
                                        new["RAW_UNEMPLOYMENT"], new["RAW_LOCAL_INCOME"], dim, CFG)
        if change.years:
            P.replace(change.rows, base, refresh.PARTITION, change.years)
        target = P.read(spark, base, change.rows.schema, refresh.PARTITION)
        ledger = spark.createDataFrame(loads(raw).collect(), "source string, loaded_at timestamp_ntz")
    full = core.fct_labour_market_regional(staging.src_unemployment(_all(spark, "RAW_UNEMPLOYMENT", seen["RAW_UNEMPLOYMENT"]), CFG),
                                           staging.src_local_income(_all(spark, "RAW_LOCAL_INCOME", seen["RAW_LOCAL_INCOME"]), CFG), dim)
    rows = lambda df: sorted(map(tuple, df.select(*full.columns).collect()), key=str)
    return rows(target), rows(full)


def _all(spark, name, frames):
    out = raw_frame(spark, name, []) if not frames else frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order_equal_a_full_build(spark, tmp_path, seed):
    """Late loads of one source under newer ones of the other, revisions, suppressed values."""
    rnd = random.Random(seed)
    order = []
    for day in range(1, 4):
        when = f"2024-01-0{day} 06:00:00"
        names = [n for _, n, _, _ in SEED]
        u = [(GROSS, rnd.choice(names), str(rnd.choice([2022, 2023])), rnd.choice(["..", str(rnd.randint(1, 9))])) for _ in range(3)]
        i = [(rnd.choice(names), UNIT, KIND, str(rnd.choice([2022, 2023])), f"{rnd.randint(100, 300)},5") for _ in range(3)]
        # a load has a cell once
        u, i = list({r[:3]: r for r in u}.values()), list({r[:4]: r for r in i}.values())
        order += [("RAW_UNEMPLOYMENT", raw_frame(spark, "RAW_UNEMPLOYMENT", u, when)),
                  ("RAW_LOCAL_INCOME", raw_frame(spark, "RAW_LOCAL_INCOME", i, when))]
    rnd.shuffle(order)
    got, want = _labour(spark, order, tmp_path, seed)
    assert got == want


def test_refresh_prunes_the_raw_history(spark, tmp_path):
    """The raw scan has a partition filter, and the semi join with the touched cells stands
    below the latest-load aggregation."""
    from keyfig.plans.config import RAW_LOCAL_INCOME, RAW_UNEMPLOYMENT
    from keyfig.plans.run import read_raw
    from keyfig.sources.sink import write_table
    for spec in (RAW_UNEMPLOYMENT, RAW_LOCAL_INCOME):
        write_table(raw_frame(spark, spec.name), f"{tmp_path}/raw/{spec.name}", partition_by=[spec.period])
    u, i = (read_raw(spark, str(tmp_path), s) for s in (RAW_UNEMPLOYMENT, RAW_LOCAL_INCOME))
    dim = core.dim_municipalities(seed_frame(spark), CFG)
    first = refresh.refresh_labour(None, u, i, u, i, dim, CFG)
    P.replace(first.rows, f"{tmp_path}/fact", refresh.PARTITION, first.years)
    target = P.read(spark, f"{tmp_path}/fact", first.rows.schema, refresh.PARTITION)
    batch = raw_frame(spark, "RAW_UNEMPLOYMENT", [(GROSS, "Northby", "2023", "130")], "2024-01-02 06:00:00")
    none = raw_frame(spark, "RAW_LOCAL_INCOME", [])
    change = refresh.refresh_labour(target, u, i, batch, none, dim, CFG)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = change.rows._jdf.queryExecution().optimizedPlan().toString()
    physical = change.rows._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", physical)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) == 3 and all("2023" in s for s in scans), scans   # two raw histories, the fact
    for line, text in enumerate(plan.splitlines()):
        if "max_by(" in text and "Aggregate" in text:
            assert any("LeftSemi" in x for x in plan.splitlines()[line + 1:line + 6]), plan


def test_history_needs_keys_and_joins_once(spark):
    schema, check = "municipality_code int, municipality_name string, region_code int, region_name string", ["municipality_name", "region_code", "region_name"]
    bad = spark.createDataFrame([(None, "X", 1, "A")], schema)
    with pytest.raises(Exception, match="without municipality_code"):
        snapshot(None, bad, "municipality_code", check, "2024-01-01 00:00:00").collect()
    h = snapshot(None, seed_frame(spark), "municipality_code", check, "2024-01-01 00:00:00")
    h = snapshot(h.withColumn("valid_to", F.when(F.col("municipality_code") == 3, F.col("valid_from"))),
                 seed_frame(spark), "municipality_code", check, "2024-02-01 00:00:00")
    plan = h._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1
