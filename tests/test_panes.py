"""Sliding periods from daily panes equal periods from copied rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import monitor as mo
from pluvio.operators import panes as pn


@pytest.fixture(scope="module")
def pairs(spark):
    rnd, rows = random.Random(6), []
    for g in ("a", "b", None):
        for i in range(300):
            for _ in range(rnd.choice([0, 1, 1, 3])):
                if not 100 < i < 170:  # a gap longer than a period
                    rows.append((g, dt.date(2023, 1, 1) + dt.timedelta(days=i), rnd.choice([0.0, 0.2, 5.0, None]), rnd.choice([0.0, 3.0, 6.0, None])))
    return spark.createDataFrame(rows, "g string, fecha date, mm_actual double, mm_predicted double")


def rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("days", [1, 30, 90])
def test_monthly_periods(pairs, days):
    copied = mo.recent_performance(mo.monthly_periods(pairs, days=days), ["g", "ref_date", "period_start", "period_end"])
    assert rows(pn.monthly_performance(pairs, days, ["g"])) == rows(copied)
    copied = mo.recent_performance(mo.monthly_periods(pairs, days=days), ["ref_date", "period_start", "period_end"])
    assert rows(pn.monthly_performance(pairs, days)) == rows(copied)


def test_every_day(pairs):
    panes = pn.daily_panes(pairs, ["g"])
    got = pn.guarded(pn.sliding(panes, pn.every_day(panes, 7, ["g"]), 7, ["g"]), "g", "end", min_days=3, min_wet=1)
    copied = pairs.withColumn("end", F.explode(F.array(*[F.date_add("fecha", k) for k in range(1, 8)])))
    assert rows(got) == rows(mo.recent_performance(copied, ["g", "end"], min_days=3, min_wet=1))


def test_plans_copy_no_rows_and_empty_input(pairs):
    """Only the list of period ends is exploded, above an aggregate."""
    plan = pn.monthly_performance(pairs, 90, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Join" not in plan and "Aggregate" in plan[plan.index("Generate"):]
    assert pn.monthly_performance(pairs.limit(0), 30, ["g"]).count() == 0 and pn.monthly_performance(pairs.limit(0)).count() == 0
