"""Delimited landing, header normalisation and ingest status."""

import pytest

from keyfig.sources import delimited as D
from keyfig.sources import ingest as ING
from keyfig.sources.sink import path_exists, table_exists, write_table


def test_header_collision_is_an_error(spark):
    df = spark.createDataFrame([("a", "b")], "`tid` string, ` TID ` string")
    with pytest.raises(ValueError):
        D.normalise_headers(df)


def test_columns_are_picked_by_name_not_position(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([("2023", "12,5", "RA")], "`Tid` string, `indhold` string, `område` string") \
        .write.option("sep", ";").option("header", True).csv(path)
    got = D.read_delimited(spark, path, ["OMRÅDE", "TID", "INDHOLD"]).collect()
    assert [tuple(r) for r in got] == [("RA", "2023", "12,5")]
    with pytest.raises(ValueError):
        D.read_delimited(spark, path, ["OMRÅDE", "MISSING"])


def test_export_counts_rows_and_land_stamps_audit(spark, tmp_path):
    path = str(tmp_path / "e")
    n = D.write_delimited(spark.createDataFrame([("RA", ".."), ("RB", "3")], "`område` string, `indhold` string"), path)
    assert n == 2
    landed = D.land_extract(spark, path, ["OMRÅDE", "INDHOLD"], "SRC", "2024-01-01 06:00:00").collect()
    assert {r["OMRÅDE"]: r["INDHOLD"] for r in landed} == {"RA": None, "RB": "3"}
    assert {r["_SRC_TABLE"] for r in landed} == {"SRC"}


def test_ingest_reports_each_source(spark, tmp_path):
    good, empty = str(tmp_path / "good"), str(tmp_path / "empty")
    D.write_delimited(spark.createDataFrame([("RA", "1")], "`OMRÅDE` string, `INDHOLD` string"), good)
    D.write_delimited(spark.createDataFrame([], "`OMRÅDE` string, `INDHOLD` string"), empty)
    specs = [ING.SourceSpec("G", "RAW_G", (good,), ("OMRÅDE", "INDHOLD")),
             ING.SourceSpec("E", "RAW_E", (empty,), ("OMRÅDE", "INDHOLD")),
             ING.SourceSpec("M", "RAW_M", (str(tmp_path / "none"),), ("OMRÅDE", "INDHOLD"))]
    wh = str(tmp_path / "wh")
    status = {r["source_id"]: (r["status"], r["rows"]) for r in ING.ingest_all(spark, specs, wh).collect()}
    assert status == {"G": ("loaded", 1), "E": ("empty", 0), "M": ("failed", 0)}
    assert table_exists(spark, f"{wh}/RAW_G") and not table_exists(spark, f"{wh}/RAW_E")
    assert path_exists(spark, good) and not path_exists(spark, str(tmp_path / "none"))


def test_sink_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    assert write_table(df, path) == 3 and write_table(df, path) == 3
    assert spark.read.parquet(path).count() == 6
    write_table(df, path, overwrite=True)
    assert spark.read.parquet(path).count() == 3


def test_landing_specs_feed_the_pipeline(spark, tmp_path):
    """Extracts landed as ';' files under <landing>/<source id>/ go through ingest into raw
    tables that the staging models read."""
    from fixtures import CFG, ROWS
    from keyfig.plans.config import RAW_SPECS, SOURCE_IDS
    from keyfig.plans.staging import src_unemployment
    landing = tmp_path / "landing"
    for spec in RAW_SPECS:
        rows = ROWS[spec.name]()
        df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in spec.columns))
        D.write_delimited(df, str(landing / SOURCE_IDS[spec.name]))
    specs = ING.landing_specs(str(landing))
    assert [s.source_id for s in specs] == ["EJ56", "EJ131", "AUL01", "INDKP101", "LABY22"]
    wh = str(tmp_path / "wh")
    status = ING.ingest_all(spark, specs, wh, loaded_at="2024-01-01 06:00:00").collect()
    assert all(r["status"] == "loaded" for r in status)
    staged = src_unemployment(spark.read.parquet(f"{wh}/RAW_UNEMPLOYMENT"), CFG)
    assert {r["area_name"]: r["gross_unemployment_count"] for r in staged.collect()}["Northby"] == 120.0


def test_files_with_another_column_order_line_up(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "1.csv").write_text("A;B\na1;b1\n", encoding="utf-8")
    (tmp_path / "x" / "2.csv").write_text("B;A\nb2;a2\n", encoding="utf-8")
    (tmp_path / "x" / "3.csv").write_text("\ufeffA;B\na3;b3\n", encoding="utf-8")
    path = str(tmp_path / "x")
    assert sorted(map(tuple, D.read_delimited(spark, path, ["A", "B"]).collect())) == [("a1", "b1"), ("a2", "b2"), ("a3", "b3")]
    assert sorted(map(tuple, D.read_delimited(spark, path).collect())) == [("a1", "b1"), ("a2", "b2"), ("a3", "b3")]
    (tmp_path / "x" / "4.csv").write_text("A;C\na4;c4\n", encoding="utf-8")
    for columns in (["A", "B"], None):
        with pytest.raises(ValueError):
            D.read_delimited(spark, path, columns)


def test_refresh_of_a_partitioned_table_leaves_no_old_partition(spark, tmp_path):
    path, mode = str(tmp_path / "t"), "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        both = spark.createDataFrame([(2020, 1), (2021, 2)], "y int, v int")
        write_table(both, path, overwrite=True, partition_by=["y"])
        write_table(both.where("y = 2021"), path, overwrite=True, partition_by=["y"])
        assert [tuple(r) for r in spark.read.parquet(path).select("y", "v").collect()] == [(2021, 2)]
    finally:
        spark.conf.set(mode, before)


def test_decimal_commas_in_every_extract(spark):
    from fixtures import CFG, HOUSE, PRICE, raw_frame
    from keyfig.plans.config import RAW_SPECS
    from keyfig.plans.staging import src_price_regional
    assert all(s.decimal_comma for s in RAW_SPECS)
    raw = raw_frame(spark, "RAW_PRICE_REGIONAL", [("RA", HOUSE, PRICE, "2023M01", "2500,5")])
    assert src_price_regional(raw, CFG).first()["avg_price_dkk_1000"] == 2500.5


def test_a_running_session_keeps_its_settings(spark):
    from keyfig.session import build_session
    keys = ["spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.sources.partitionOverwriteMode"]
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "20", "static"), strict=True):
            spark.conf.set(k, v)
        again = build_session(shuffle_partitions=8)
        assert [again.conf.get(k) for k in keys] == ["false", "20", "static"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_landing_reports_what_it_could_not_read(spark, tmp_path):
    D.write_delimited(spark.createDataFrame([("RA", "1")], "`OMRÅDE` string, `INDHOLD` string"), str(tmp_path / "good"))
    D.write_delimited(spark.createDataFrame([("RA", "1")], "`OMRÅDE` string, `ANDET` string"), str(tmp_path / "other"))
    specs = [ING.SourceSpec(n, f"RAW_{n}", (str(tmp_path / n),), ("OMRÅDE", "INDHOLD")) for n in ("good", "other", "none")]
    landed, status = ING.land_all(spark, specs, "2024-01-01 06:00:00")
    assert list(landed) == ["RAW_good"] and landed["RAW_good"].count() == 1
    assert {(s[0], s[2]) for s in status} == {("other", "failed"), ("none", "failed")}
