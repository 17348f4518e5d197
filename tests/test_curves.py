import random

from pyspark.sql import functions as F

from helpers import rows, ts_of
from wattloom.operators import (
    active_power,
    phase_pivot,
    power_pivot,
    pqvcf,
    pv_curve,
    qv_curve,
    reactive_power,
)
from wattloom.settings import CURRENT_PHASES, FACTOR_PHASES, VOLT_PHASES


def long(spark, data, flag, value):
    return spark.createDataFrame(
        [(i, ts_of(d), d, f, v) for i, d, f, v in data],
        f"id long, ts timestamp_ntz, dti long, {flag} int, {value} double",
    )


def test_curves_keep_every_power_row(spark):
    volts = phase_pivot(
        long(spark, [(1, 1, 3, 220.0), (1, 2, 1, 221.0)], "phase_flag", "volt"), "volt", VOLT_PHASES
    )
    power = long(
        spark,
        [(1, 1, 1, 0.5), (1, 1, 1, 0.5), (1, 1, 5, 0.1), (1, 2, 1, 0.7), (1, 3, 1, 9.0), (1, 1, 1, None)],
        "data_type", "power",
    )
    assert active_power(power).count() == 4 and reactive_power(power).count() == 1
    assert sorted(r[:5] for r in pv_curve(volts, power).na.fill(-1.0).collect()) == [
        (1, ts_of(1), 220.0, 0.5, 1), (1, ts_of(1), 220.0, 0.5, 1), (1, ts_of(2), -1.0, 0.7, 2),
    ]
    (q,) = qv_curve(volts, power).collect()
    assert (q.power, q.sdti, q.season, q.daytype) == (0.1, 10, 4, 1)


def test_pqvcf_equals_pivots_and_joins(spark):
    rng = random.Random(5)

    def some(flags, n):
        # Zeros and nulls appear often enough to exercise the presence and activity rules.
        return [
            (rng.randrange(1, 4), rng.randrange(1, 30), rng.choice(flags), rng.choice([None, 0.0, 0.0, 1.5, 2.0]))
            for _ in range(n)
        ]

    volt = long(spark, some([0, 1, 2, 3], 90), "phase_flag", "volt")
    cur = long(spark, some([1, 2, 3], 60), "phase_flag", "cur")
    pf = long(spark, some([0, 1, 2, 3], 30), "phase_flag", "pf")
    power = long(spark, some(list(range(1, 9)), 120), "data_type", "power")
    v = phase_pivot(volt, "volt", VOLT_PHASES).drop("ts")
    c = phase_pivot(cur, "cur", CURRENT_PHASES).drop("ts")
    f = phase_pivot(pf, "pf", FACTOR_PHASES).drop("ts")
    joined = power_pivot(power).join(v, ["id", "dti"]).join(c, ["id", "dti"]).join(f, ["id", "dti"], "left")
    for phases in (("a", "c"), ("a", "b", "c")):
        got = pqvcf(volt, power, cur, pf, phases=phases)
        assert len(got.columns) == 21
        watched = ["psum"] + [f"{k}{p}" for k in ("volt_", "p", "cur_") for p in phases]
        want = joined.filter(" OR ".join(f"{w} > 0" for w in watched)).select(got.columns)
        key = [F.col(x).asc_nulls_first() for x in got.columns]
        assert got.orderBy(*key).collect() == want.orderBy(*key).collect()
        assert got.count() > 5


def test_pqvcf_shuffles_once(spark):
    parts = [long(spark, [(1, 1, 1, 1.0)], f, v) for f, v in
             (("phase_flag", "volt"), ("data_type", "power"), ("phase_flag", "cur"), ("phase_flag", "pf"))]
    plan = pqvcf(*parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
