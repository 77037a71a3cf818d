"""The labour state (signed deltas) and the change store: load orders, replays, deaths, upkeep."""

import random

import pytest
from fixtures import CFG, GROSS, KIND, SEED, UNIT, raw_frame, seed_frame
from pyspark.sql import functions as F

from keyfig.operators.changes import Store, append_load, newest, read_loads
from keyfig.plans import core, staging
from keyfig.plans.state import CELL_KEYS, CELLS, YEAR, LabourState

NONE = {"RAW_UNEMPLOYMENT": [], "RAW_LOCAL_INCOME": []}


def rebuilt(spark, loads, dim):
    raw = {}
    for name in NONE:
        raw[name] = raw_frame(spark, name, [])
        for n, df in loads:
            raw[name] = raw[name].unionByName(df) if n == name else raw[name]
    return core.fct_labour_market_regional(staging.src_unemployment(raw["RAW_UNEMPLOYMENT"], CFG), staging.src_local_income(raw["RAW_LOCAL_INCOME"], CFG), dim)


def rows(df, names=None):
    return sorted(map(tuple, df.select(*(names or df.columns)).collect()), key=str)


def apply(spark, state, name, df):
    frames = {n: raw_frame(spark, n, []) for n in NONE} | {name: df}
    applied = state.apply(frames["RAW_UNEMPLOYMENT"], frames["RAW_LOCAL_INCOME"])
    state.commit(applied)
    return applied


def random_loads(spark, rnd):
    out = []
    for day in range(1, 4):
        when = f"2024-01-0{day} 06:00:00"
        names = [n for _, n, _, _ in SEED] + ["Nowhereby", "Region A"]
        value = lambda: rnd.choice(["..", "0", str(rnd.randint(1, 9)), "2000000000000001", f"{rnd.randint(1, 9)}.25"])
        u = [(GROSS, rnd.choice(names), rnd.choice(["2022", "2023", "02023"]), value()) for _ in range(5)]
        i = [(rnd.choice(names), UNIT, KIND, rnd.choice(["2022", "2023"]), value()) for _ in range(4)]
        u, i = list({r[:3]: r for r in u}.values()), list({r[:4]: r for r in i}.values())
        out += [("RAW_UNEMPLOYMENT", raw_frame(spark, "RAW_UNEMPLOYMENT", u, when)), ("RAW_LOCAL_INCOME", raw_frame(spark, "RAW_LOCAL_INCOME", i, when))]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order_equal_a_rebuild(spark, tmp_path, seed):
    rnd = random.Random(seed)
    loads = random_loads(spark, rnd)
    rnd.shuffle(loads)
    dim = core.dim_municipalities(seed_frame(spark), CFG, with_load_time=False)
    state = LabourState(spark, str(tmp_path / "s"), dim, CFG, buckets=2)
    for k, (name, df) in enumerate(loads):
        apply(spark, state, name, df)
        if k == 3:
            assert state.compact(changes=1) > 0
    want = rebuilt(spark, loads, dim)
    assert rows(state.fact(), want.columns) == rows(want)
    before = rows(state.fact())
    apply(spark, state, *loads[0])   # a load applied again, an old one: nothing changes
    assert rows(state.fact()) == before
    state.store.vacuum(1)
    assert rows(state.fact()) == before


def test_children_that_move_region_move_their_measures(spark, tmp_path):
    loads = random_loads(spark, random.Random(7))
    dim = core.dim_municipalities(seed_frame(spark), CFG, with_load_time=False)
    base = str(tmp_path / "s")
    for name, df in loads[:4]:
        apply(spark, LabourState(spark, base, dim, CFG), name, df)
    moved = dim.withColumn("region_name", F.when(F.col("municipality_name") == "Eastby", "Region B").otherwise(F.col("region_name")))
    for name, df in loads[4:]:
        apply(spark, LabourState(spark, base, moved, CFG), name, df)
    want = rebuilt(spark, loads, moved)
    assert rows(LabourState(spark, base, moved, CFG).fact(), want.columns) == rows(want)


def test_a_staged_change_is_seen_by_nobody_else(spark, tmp_path):
    dim = core.dim_municipalities(seed_frame(spark), CFG, with_load_time=False)
    state = LabourState(spark, str(tmp_path / "s"), dim, CFG)
    first, second = (raw_frame(spark, "RAW_UNEMPLOYMENT", [(GROSS, "Northby", "2023", v)], f"2024-01-0{d} 06:00:00") for d, v in ((1, "5"), (2, "7")))
    apply(spark, state, "RAW_UNEMPLOYMENT", first)
    applied = state.apply(second, raw_frame(spark, "RAW_LOCAL_INCOME", []))
    assert [r["total_gross_unemployment"] for r in state.fact().collect()] == [5.0]
    assert [r["total_gross_unemployment"] for r in state.fact(applied).collect()] == [7.0]
    # the job dies here; the retry commits a change of its own, the dead one stays unseen
    apply(spark, state, "RAW_UNEMPLOYMENT", second)
    assert [r["total_gross_unemployment"] for r in state.fact().collect()] == [7.0]
    with pytest.raises(RuntimeError, match="no longer the newest"):
        state.commit(applied)


def test_a_load_reads_only_the_buckets_of_its_cells(spark, tmp_path):
    dim = core.dim_municipalities(seed_frame(spark), CFG, with_load_time=False)
    state = LabourState(spark, str(tmp_path / "s"), dim, CFG, buckets=16)
    apply(spark, state, "RAW_UNEMPLOYMENT", raw_frame(spark, "RAW_UNEMPLOYMENT", [(GROSS, f"Town {k}", str(y), "1") for k in range(60) for y in (2021, 2022, 2023)]))
    live = state.store.live("cells")
    assert all(len(b) > 12 for b in live.values())
    new = raw_frame(spark, "RAW_UNEMPLOYMENT", [(GROSS, "Town 1", "2023", "3")], "2024-01-02 06:00:00")
    applied = state.apply(new, raw_frame(spark, "RAW_LOCAL_INCOME", []))
    (year, held), = applied.cells["parts"].items()
    assert year == "period_year=2023" and len(held) == 1 and applied.years == [2023]
    old = state.store.read("cells", CELLS, YEAR, CELL_KEYS, ["loaded_at"], [2023], [int(b) for b in held])
    files = old.inputFiles()
    assert len(files) == 1 and f"period_year=2023/_bucket={next(iter(held))}" in files[0]


# ------------------------------------------------------------------------------- loads, merges

LOAD = "k string, v int, t string"


def test_a_load_is_there_once_or_not_at_all(spark, tmp_path):
    base = str(tmp_path / "raw")
    one = spark.createDataFrame([("a", 1, "01"), ("b", 2, "2024Q1"), ("c", 3, None)], LOAD)
    assert append_load(one, base, "day 1", "t", ["v"]) == 3
    broken = one.withColumn("v", F.raise_error(F.lit("the cluster died")).cast("int"))
    with pytest.raises(Exception, match="the cluster died"):
        append_load(broken, base, "day 2", "t")
    store = Store(spark, base)
    store.stage(one, "rows", "t")        # died between writing and its manifest entry
    read = lambda loads=None: sorted(map(tuple, read_loads(spark, base, one.schema, "t", loads).collect()), key=str)
    assert read() == sorted([("a", 1, "01"), ("b", 2, "2024Q1"), ("c", 3, None)], key=str)
    two = spark.createDataFrame([("d", 4, "01")], LOAD)
    assert [append_load(two, base, "day 2", "t", ["v"]) for _ in range(3)] == [1, 1, 1]   # retries
    assert len(read()) == 4 and read(["day 2"]) == [("d", 4, "01")]
    assert store.vacuum() >= 1 and len(read()) == 4   # the dead attempts are gone
    assert append_load(one.limit(0), base, "empty", "t") == 0 and len(read()) == 4


def test_the_newest_load_is_known_without_reading(spark, tmp_path):
    base = str(tmp_path / "raw")
    assert newest(spark, base, "at") is None
    for day in (3, 1):
        append_load(spark.sql(f"SELECT 'x' AS t, TIMESTAMP_NTZ'2024-01-0{day} 06:00:00' AS at"), base, str(day), "t", ["at"])
    assert str(newest(spark, base, "at")) == "2024-01-03 06:00:00"


def test_changes_merge_by_key_and_compact(spark, tmp_path):
    store = Store(spark, str(tmp_path / "m"))
    want, rnd = {}, random.Random(1)
    schema = spark.createDataFrame([], LOAD).schema
    for _ in range(5):
        up = {f"k{rnd.randrange(12)}": rnd.randrange(100) for _ in range(4)}
        dead = [k for k in {f"k{rnd.randrange(12)}" for _ in range(2)} if k not in up]
        part = lambda k: str(int(k[1:]) % 3)
        df = spark.createDataFrame([(k, v, part(k)) for k, v in up.items()], LOAD)
        gone = spark.createDataFrame([(k, part(k)) for k in dead], "k string, t string") if dead else None
        store.commit([store.stage(df, "m", "t", ["k"], 4, gone)])
        want = {k: v for k, v in (want | up).items() if k not in dead}
        assert {r["k"]: r["v"] for r in store.read("m", schema, "t", ["k"]).collect()} == want
    before = store.read("m", schema, "t", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert store.compact("m", schema, "t", ["k"], None, 4, changes=1) > 0
    after = store.read("m", schema, "t", ["k"])
    assert {r["k"]: r["v"] for r in after.collect()} == want
    assert "Aggregate" in before and "Aggregate" not in after._jdf.queryExecution().executedPlan().toString()
    assert store.vacuum(1) > 0 and {r["k"]: r["v"] for r in store.read("m", schema, "t", ["k"]).collect()} == want


# ------------------------------------------------------------------------------- history, places

def test_a_snapshot_leaves_closed_versions_alone(spark, tmp_path):
    from keyfig.operators.history import History, snapshot
    schema, check = "code int, name string", ["name"]
    days = [[(1, "a"), (2, "b"), (3, "c")], [(1, "A"), (2, "b")], [(1, "A"), (2, "B"), (4, "d")], [(1, "A"), (2, "B"), (4, "d")], [(1, "A"), (2, "B"), (3, "c")]]
    kept, plain = History(spark, str(tmp_path / "h"), "code", check, buckets=2), None
    for m, rows_ in enumerate(days, 1):
        ts, df = f"2024-0{m}-01 00:00:00", spark.createDataFrame(rows_, schema)
        for _ in range(2):   # the second is the same snapshot again
            kept.take(df, ts)
        plain = snapshot(plain, df, "code", check, ts)
        assert rows(kept.read().select(*plain.columns)) == rows(plain)
    loads = kept.store.state()["loads"]
    assert len(loads) == len(days) and loads["2024-04-01 00:00:00"]["rows"] == 0   # nothing changed in the fourth month
    assert {p for p in kept.store.live("closed")} == {"_closed=2024-02", "_closed=2024-03", "_closed=2024-05"}
    assert all("/closed/" not in f for f in kept.open().inputFiles())
    assert [tuple(r) for r in kept.closed(["2024-03"]).select("code", "name").collect()] == [(2, "b")]


def test_sorted_places_hold_when_files_are_split(spark):
    from keyfig.operators.windows import with_position
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    df = spark.range(100).withColumn("x", F.pmod(F.col("id") * 37, F.lit(100))).repartition(3)
    got = {r["x"]: r["place"] for r in with_position(df, ["x"]).collect()}
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert got == {k: k + 1 for k in range(100)}


def test_a_replayed_batch_adds_no_version(spark, tmp_path):
    from keyfig.streaming.filestream import stream_latest_cells
    base, schema = str(tmp_path), "k string, t string, v string, at timestamp_ntz"
    land = lambda n, rows_: spark.createDataFrame(rows_, "k string, t string, v string, at string").withColumn("at", F.col("at").cast("timestamp_ntz")).write.parquet(f"{base}/landing/load={n}")
    kind = spark.createDataFrame([], schema).schema
    run = lambda: sorted(map(tuple, stream_latest_cells(spark, f"{base}/landing/*", kind, ["k", "t"], ["at", "v"], f"{base}/cells", f"{base}/check", "t").select("k", "t", "v").collect()))
    land(1, [("a", "01", "1", "2024-01-02"), ("b", "1", "5", "2024-01-02")])
    run()
    land(2, [("a", "01", "0", "2024-01-01"), ("b", "1", "6", "2024-01-03"), ("c", "2024Q1", "7", "2024-01-03")])
    want = [("a", "01", "1"), ("b", "1", "6"), ("c", "2024Q1", "7")]
    assert run() == want
    store = Store(spark, f"{base}/cells")
    before = store.state()
    # the driver died after the table's commit, before the checkpoint's: the batch runs again
    for f in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / f).unlink(missing_ok=True)
    assert run() == want and store.state() == before and list(before["batches"].values()) == [1]


def test_incremental_models_follow_their_columns(spark, tmp_path):
    from keyfig.sources.sink import materialise
    path = str(tmp_path / "m")
    materialise(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, name string, old string"), "incremental", path=path, keys=["id"])
    got = materialise(spark.createDataFrame([(2, "B", 7), (3, "c", 8)], "id int, name string, new int"), "incremental", path=path, keys=["id"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, "B", 7), (3, "c", 8)]
    with pytest.raises(ValueError):
        materialise(got, "nowhere")


def test_profiles_merge_from_sketches(spark, tmp_path):
    from keyfig.operators.profile import profile_estimate, profile_load
    base = str(tmp_path / "p")
    df = spark.range(30_000).select(F.col("id").cast("string").alias("big"), (F.col("id") % 7).cast("string").alias("small"))
    low, high = df.where("CAST(big AS int) < 20000"), df.where("CAST(big AS int) >= 10000")
    for _ in range(2):   # a load counts once
        profile_load(low, ["big", "small"], base, "one")
        profile_load(high, ["big", "small"], base, "two")
    got = {r["variable"]: (r["n_values_estimate"], r["n_rows"]) for r in profile_estimate(spark, base).collect()}
    assert got["small"] == (7, 40_000) and got["big"][1] == 40_000
    assert abs(got["big"][0] - 30_000) < 3 * 0.008 * 30_000


def test_metadata_is_read_in_one_pass_and_keeps_unknown_fields(spark, tmp_path):
    from keyfig.operators.profile import read_metadata, variable_members
    (tmp_path / "m.json").write_text('{"id": "TAL", "text": "Tal", "values": [{"id": "a", "text": "A"}, {"id": "b", "text": "B", "more": 1}], "unit": {"k": 1}}\n{"id": "Tid", "time": true, "values": []}\n')
    meta = read_metadata(spark, str(tmp_path / "m.json"))
    assert sorted(map(tuple, variable_members(meta, "tal").collect())) == [("a", "A"), ("b", "B")]
    assert meta.where("id = 'TAL'").select(F.variant_get("document", "$.unit.k", "int")).first()[0] == 1
    assert [r["time"] for r in meta.orderBy("id").collect()] == [None, True]
