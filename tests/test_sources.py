import os

import pytest

from helpers import rows
from wattloom.lineage import scratch, shared_folder
from wattloom.sources import (
    OUTPUTS,
    RangePartition,
    file_sink,
    publish,
    read_series_csv,
    read_table,
    series_from_lines,
    write_series_csv,
    write_table,
)
from wattloom.sources.tables import read_options


def test_jdbc_scan_options():
    part = RangePartition("dti", 1, 35040, 100)
    query = "(select meterid from meter) ids"
    assert read_options(query, url="jdbc:x", partition=part, options={"fetchsize": "1000"}) == {
        "url": "jdbc:x", "dbtable": query, "fetchsize": "1000", "partitionColumn": "dti",
        "lowerBound": "1", "upperBound": "35040", "numPartitions": "100",
    }
    assert "partitionColumn" not in read_options("t", url="jdbc:x")


def test_jdbc_needs_a_url(spark):
    with pytest.raises(ValueError):
        read_table(spark, "t", format="jdbc")
    with pytest.raises(ValueError):
        write_table(spark.range(1), "t", format="jdbc")
    with pytest.raises(ValueError):
        read_table(spark, "t", partition=RangePartition("id", 0, 1, 2))


def test_parquet_round_trip_by_season(spark, tmp_path):
    path = str(tmp_path / "pv")
    df = spark.range(100).selectExpr("id", "int(id % 4 + 1) AS season", "int(id % 2 + 1) AS daytype")
    write_table(df, path, partition_by=("season", "daytype"), sort_by=("id",))
    assert sorted(p for p in os.listdir(path) if "=" in p) == [f"season={n}" for n in range(1, 5)]
    back = read_table(spark, path)
    assert rows(back.select("id", "season", "daytype")) == rows(df)
    plan = back.filter("season = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    with pytest.raises(Exception):
        write_table(df, path)
    write_table(df.limit(3), path, mode="overwrite", width=1)
    assert read_table(spark, path).count() == 3
    write_table(df.limit(3), path, mode="append", width=1)
    assert read_table(spark, path).count() == 6


def test_series_files(spark, tmp_path):
    lines = ["110,240.0", "110,null", "110,-999.0", "110,553.5"]
    path = tmp_path / "series"
    path.mkdir()
    (path / "part-00000").write_text("\n".join(lines) + "\n")
    (path / "part-00001").write_text("111,1.5\n")
    got = sorted(read_series_csv(spark, str(path), value="volt").collect(), key=str)
    assert {(r.id, r.volt) for r in got} == {(110, 240.0), (110, None), (110, 553.5), (111, 1.5)}
    kept = read_series_csv(spark, str(path), sentinel=None)
    assert kept.filter("value = -999.0").count() == 1
    (tmp_path / "single").write_text("0.2598\nnull\n")
    assert {r.power for r in read_series_csv(spark, str(tmp_path / "single"), value="power", with_id=False).collect()} == {
        0.2598, None,
    }
    parsed = series_from_lines(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    assert [tuple(r) for r in parsed.collect()] == [(110, 240.0), (110, None), (110, None), (110, 553.5)]


def test_publish_follows_the_run_mode(spark):
    tables = {name: spark.range(1) for name in OUTPUTS}
    for run_mode, expected in {
        1: {"pvsd", "qvsd", "meterids", "hourgroup", "irregular"},
        2: {"datetimeinterval", "volt", "basereading", "identifiedobject", "enddevice", "meter",
            "voltoutsum", "pvcurve", "qvcurve"},
        3: {"voltagelow", "voltagehigh", "voltageout", "pvcurve", "qvcurve"},
        4: {"pqvcf", "meterids", "pvsdhg", "pvhg"},
    }.items():
        seen = {}
        done = publish(tables, run_mode, lambda name, df, rule: seen.update({name: rule.mode}))
        assert set(done) == set(seen) == expected | {"hourgroup2", "pvsdhg2", "qvsdhg2"}
    assert seen["pqvcf"] == "errorifexists"
    assert (OUTPUTS["pqvcf"].width, OUTPUTS["meter"].width) == (140, 70)
    with pytest.raises(KeyError):
        publish({"nothing": spark.range(1)}, 1, lambda *a: None)


def test_width_does_not_narrow_the_stage_before(spark, tmp_path):
    tasks = spark.range(0, 600, 1, 6).selectExpr("id", "spark_partition_id() AS task")
    for name, sort_by in (("plain", ()), ("sorted", ("id",))):
        path = str(tmp_path / name)
        write_table(tasks, path, width=2, sort_by=sort_by)
        back = read_table(spark, path)
        assert back.select("task").distinct().count() == 6 and back.count() == 600
        assert len([p for p in os.listdir(path) if p.startswith("part-")]) == 2


def test_series_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "series")
    data = [(i % 50, None if i % 7 == 0 else i / 4) for i in range(2000)]
    write_series_csv(spark.createDataFrame(data, "id long, value double").repartition(4), path)
    series = read_series_csv(spark, path)
    assert sorted(map(tuple, series.collect()), key=str) == sorted(data, key=str)
    assert sorted(map(tuple, series.filter("id = 3").collect()), key=str) == sorted((r for r in data if r[0] == 3), key=str)
    plan = series.filter("id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,3)]" in plan
    assert series.rdd.getNumPartitions() > 1


def test_publishing_twice_leaves_the_same_rows(spark, tmp_path):
    sink = file_sink(str(tmp_path), "monday")
    df = spark.range(40).selectExpr("id", "int(id % 4 + 1) AS season", "int(id % 2 + 1) AS daytype")
    read = lambda name: read_table(spark, str(tmp_path / name))
    for _ in range(2):
        # One table that is appended by season, one that is overwritten, one that must be new.
        assert publish({"pvcurve": df, "meterids": df, "hourgroup2": df}, 2, sink) == {"pvcurve": 40, "hourgroup2": 40}
        assert publish({"voltagelow": df.limit(0)}, 3, sink) == {"voltagelow": 0}
        assert read("pvcurve").count() == read("hourgroup2").count() == 40
    assert publish({"pvcurve": df.limit(7)}, 2, file_sink(str(tmp_path), "tuesday")) == {"pvcurve": 7}
    assert {r.run: r["count"] for r in read("pvcurve").groupBy("run").count().collect()} == {"monday": 40, "tuesday": 7}
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), replace_partitions=True)


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError):
        shared_folder(Session())
    assert scratch(spark, "a") != scratch(spark, "a")
