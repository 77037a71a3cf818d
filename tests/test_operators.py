"""Operator properties and the quality checks on planted faults."""

import random

from pyspark.sql import functions as F

from keyfig.operators import incremental as I
from keyfig.operators import profile as PR
from keyfig.operators import quality as Q
from keyfig.operators import reshape as R
from keyfig.operators import windows as W

MAPPING = {"a": "m_a", "b": "m_b", "c": "m_c"}


def long_rows(n=60, seed=7):
    rnd = random.Random(seed)
    return [(f"g{rnd.randint(0, 9)}", rnd.choice("abcz"), f"t{i}", float(rnd.randint(0, 100))) for i in range(n)]


def test_pivot_is_order_independent_and_inverts(spark):
    rows = [(g, m, "p", v) for g, m, _, v in long_rows()]
    # one cell per (group, member): keep the first
    seen, cells = set(), []
    for g, m, p, v in rows:
        if (g, m) not in seen:
            seen.add((g, m))
            cells.append((g, m, p, v))
    schema = "g string, metric string, p string, v double"
    a = R.pivot_metrics(spark.createDataFrame(cells, schema), ["g"], "metric", "v", MAPPING, resolve="max")
    b = R.pivot_metrics(spark.createDataFrame(list(reversed(cells)), schema), ["g"], "metric", "v", MAPPING,
                        resolve="max")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    back = R.unpivot_metrics(a, ["g"], MAPPING, "metric", "v")
    expected = sorted((g, m, v) for g, m, _, v in cells if m in MAPPING)
    assert sorted(map(tuple, back.collect())) == expected


def test_latest_by_picks_newest_then_largest(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 3, "y"), ("k", 3, "z"), ("j", 2, None)],
                               "key string, ts int, v string")
    got = {r["key"]: (r["ts"], r["v"]) for r in R.latest_by(df, ["key"], ["ts", "v"]).collect()}
    assert got == {"k": (3, "z"), "j": (2, None)}


def test_upsert_twice_equals_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = I.upsert(target, batch, "k")
    twice = I.upsert(once, batch, "k")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "B"), (3, "C")]


def test_upsert_rejects_duplicate_batch_keys(spark):
    import pytest
    batch = spark.createDataFrame([(2, "B"), (2, "C")], "k int, v string")
    with pytest.raises(ValueError):
        I.upsert(None, batch, "k")


def test_versioned_publish_and_watermark(spark, tmp_path):
    base = str(tmp_path / "t")
    assert I.read_current(spark, base) is None and I.watermark(None) is None
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "k int, _loaded_at string").withColumn(
        "_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))
    I.publish(df, base)
    I.publish(df.withColumn("k", F.lit(2)), base)
    assert I.current_version(spark, base) == 2
    assert [r["k"] for r in I.read_current(spark, base).collect()] == [2]
    src = spark.createDataFrame([("2023-12-31 00:00:00",), ("2024-01-02 00:00:00",)], "_LOADED_AT string").withColumn(
        "_LOADED_AT", F.col("_LOADED_AT").cast("timestamp_ntz"))
    assert I.after_watermark(src, I.watermark(I.read_current(spark, base))).count() == 1
    assert I.after_watermark(src, None).count() == 2   # empty target: load everything


def test_quality_checks_return_exactly_the_planted_rows(spark):
    df = spark.createDataFrame(
        [(1, "AFFORDABLE", 100.0), (1, "AFFORDABLE", 200.0), (None, "WHATEVER", -1.0), (4, None, 2000001.0)],
        "id int, tier string, income double")
    assert [r["id"] for r in Q.unique(df, "id").collect()] == [1]
    assert Q.not_null(df, "id").count() == 1
    assert [r["tier"] for r in Q.accepted_values(df, "tier", ["AFFORDABLE"]).collect()] == ["WHATEVER"]
    assert sorted(r["income"] for r in Q.between(df, "income", 0, 2_000_000).collect()) == [-1.0, 2000001.0]
    res = Q.run_checks(spark, {"t": df}, [Q.Check("unique", "t", "id"), Q.Check("not_null", "t", "id"),
                                          Q.Check("accepted_values", "t", "tier", values=("AFFORDABLE",)),
                                          Q.Check("between", "t", "income", min_value=0, max_value=2_000_000)])
    got = {(r["check_name"], r["column_name"]): (r["failures"], r["status"]) for r in res.collect()}
    assert got == {("unique", "id"): (1, "fail"), ("not_null", "id"): (1, "fail"),
                   ("accepted_values", "tier"): (1, "fail"), ("between", "income"): (2, "fail")}


def test_freshness_status(spark):
    fresh = spark.createDataFrame([("2024-04-10 06:00:00",)], "_LOADED_AT string").withColumn(
        "_LOADED_AT", F.col("_LOADED_AT").cast("timestamp_ntz"))
    stale = fresh.withColumn("_LOADED_AT", F.lit("2023-01-01 00:00:00").cast("timestamp_ntz"))
    res = Q.freshness({"A": fresh, "B": stale}, {"A": (1, 10), "B": (40, 70)}, "2024-04-15 06:00:00")
    assert {r["source_name"]: r["status"] for r in res.collect()} == {"A": "warn", "B": "error"}


def test_profile_and_cell_estimate_bound(spark):
    rows = [(a, b, t) for a in "xyz" for b in "pq" for t in ("2023", "2024") if not (a == "z" and b == "q")]
    df = spark.createDataFrame(rows, "A string, B string, TID string")
    prof = {r["variable"]: r for r in PR.dimension_profile(df, ["A", "B", "TID"], "TID").collect()}
    assert prof["A"]["n_values"] == 3 and prof["A"]["sample_values"] == "x,y,z" and prof["TID"]["is_time"]
    est = PR.estimate_cells(PR.dimension_profile(df, ["A", "B", "TID"], "TID")).first()
    assert est["n_rows"] == 12 and est["n_cells"] == 48
    assert est["n_rows"] >= df.count()   # the estimate never undercounts actual cells


def test_first_k_members_is_exact_with_salting(spark):
    rows = [("v", f"m{i:04d}") for i in range(500)]
    df = spark.createDataFrame(rows, "variable string, member string")
    got = W.first_k_members(df, "variable", "member", k=5, salt_buckets=16).first()["first_members"]
    assert got == "m0000,m0001,m0002,m0003,m0004"


def test_change_vs_previous_respects_gaps(spark):
    df = spark.createDataFrame([("a", 2020, 10.0), ("a", 2021, 12.0), ("a", 2023, 15.0)],
                               "k string, y int, v double")
    got = {r["y"]: r["change"] for r in W.change_vs_previous(df, ["k"], "y", "v").collect()}
    assert got == {2020: None, 2021: 2.0, 2023: None}


def test_publish_retries_over_an_uncommitted_attempt(spark, tmp_path):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "k int")
    I.publish(df, base)
    # a crashed attempt at version 2: files but no _SUCCESS marker
    (tmp_path / "t" / "_version=2").mkdir()
    (tmp_path / "t" / "_version=2" / "part-00000-garbage.parquet").write_bytes(b"not parquet")
    assert I.current_version(spark, base) == 1
    I.publish(df.withColumn("k", F.lit(2)), base)
    assert I.current_version(spark, base) == 2
    assert [r["k"] for r in I.read_current(spark, base).collect()] == [2]


def test_positions_are_those_of_the_whole_sort(spark):
    rows = [(i * 7919 % 1000, f"v{i % 13}") for i in range(1000)] + [(None, "n")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(7)
    got = sorted((r["place"], r["k"]) for r in W.with_position(df, ["k"]).collect())
    assert got == [(1, None)] + [(i + 2, i) for i in range(1000)]
    assert W.with_position(df.limit(0), ["k"]).count() == 0


def test_metadata_has_one_layout_at_every_size(spark):
    for n in (3, 2000):
        df = spark.range(n).select(F.concat(F.lit("m"), "id").alias("A"), F.lit("2023").alias("TID"))
        doc = PR.metadata_document(df, ["A", "TID"], "TID", buckets=4)
        assert doc.where("id = 'A'").count() <= 4 and doc.where("id = 'TID'").count() == 1
        assert sorted(r["id"] for r in PR.variable_members(doc, "a").collect()) == sorted(f"m{i}" for i in range(n))
