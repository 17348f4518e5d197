import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from helpers import EPOCH
from wattloom.operators import interval_calendar_of, meter_dims
from wattloom.plans import cut, day_curves, ingest, load_model
from wattloom.plans.queries import QUERIES
from wattloom.settings import CURVE_FAMILIES, DAY_CURVES, MeterSettings
from wattloom.sources import publish, read_table, sample, write_table

SF = "/root/testdata/sf0.001"
SETTINGS = dataclasses.replace(MeterSettings(), epoch=EPOCH, calendar_days=300, station_first_meter=1)


def test_ingest_publishes_each_mode(spark, tmp_path):
    rows = sample.readings(spark, SF)
    wide = {value: sample.wide_curve(rows, value) for value in CURVE_FAMILIES}
    outputs = ingest(
        wide,
        sample.reading_type_table(spark, SF),
        sample.measurement_kinds(spark),
        sample.phases(spark),
        SETTINGS,
    )

    def sink(name, df, rule):
        write_table(df, str(tmp_path / name), mode=rule.mode, partition_by=rule.partition_by)

    for run_mode in (2, 3):
        publish(outputs, run_mode, sink)
    read = lambda name: read_table(spark, str(tmp_path / name))
    assert read("datetimeinterval").count() == 300 * 96
    # One meter, 28 days, three phases and the total: all cells of the wide curve.
    assert read("volt").count() == 28 * 4 * 96
    cells = rows.filter("volt IS NOT NULL AND phase_flag > 0").select("id", "dti", "phase_flag").distinct().count()
    facts = read("basereading").join(
        sample.reading_type_table(spark, SF).withColumnRenamed("readingtypeid", "readingtype"), "readingtype"
    )
    assert facts.filter("measurementkind = 1").count() == cells
    assert read("pvcurve").count() == 2 * outputs["pvcurve"].count()
    assert {"season", "daytype"} <= set(read("pvcurve").columns)
    assert read("meter").count() == 1


def test_load_model_from_curve_to_labels(spark, tmp_path):
    curve = sample.direct_curve(sample.readings(spark, SF))
    out = load_model(curve, curve, SETTINGS)
    assert out["hourgroup"].count() == 8 * 24
    assert out["irregular"].count() == 0
    assert out["pvsdhg"].count() == out["qvsdhg2"].count() == curve.count()
    assert out["pvsdhg"].filter("hourgroup < 0").count() == 0
    assert out["pvhg"].count() == curve.filter("volt_c BETWEEN 154 AND 300 AND power IS NOT NULL").count()
    nobody = spark.createDataFrame([(77,)], "id long")
    assert load_model(curve, curve, SETTINGS, meters=nobody)["hourgroup"].count() == 0


def test_day_curves_of_a_station(spark):
    rows = sample.readings(spark, SF)
    outputs = ingest(
        {value: sample.wide_curve(rows, value) for value in CURVE_FAMILIES},
        sample.reading_type_table(spark, SF),
        sample.measurement_kinds(spark),
        sample.phases(spark),
        SETTINGS,
    )
    curves = day_curves(
        {
            "basereading": outputs["basereading"],
            **meter_dims(rows),
            "readingtype": sample.reading_type_table(spark, SF),
            "measurementkind": sample.measurement_kinds(spark),
            "datetimeinterval": interval_calendar_of(rows, EPOCH),
        },
        SETTINGS,
    )
    assert curves["summary"].count() == outputs["basereading"].count()
    for code in DAY_CURVES:
        assert curves[code].count() == 28, code


def test_cut_uses_the_named_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    copy = cut(df)
    assert copy.collect() == df.collect()
    if spark.conf.get("spark.checkpoint.dir", None):
        assert "ExistingRDD" in copy._jdf.queryExecution().toString()
    else:
        assert copy is df


# The JVM does not compile a method of over 8,000 bytes, and every row then runs interpreted.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"elbow_cost"}))
def test_generated_methods_can_be_compiled(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution()
        text = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert not sizes or max(sizes) < 8000
