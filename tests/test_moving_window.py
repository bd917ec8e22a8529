import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from namekin.operators import moving_window as mw

FIRST = dt.date(2001, 1, 1)


@pytest.mark.parametrize("old, new", [
    (("2001-01-05", "2001-02-05"), ("2001-01-20", "2001-02-20")), (("2001-01-20", "2001-02-20"), ("2001-01-05", "2001-02-05")),
    (("2001-01-01", "2001-01-10"), ("2001-02-01", "2001-02-10")), (("2001-01-01", "2001-03-01"), ("2001-01-10", "2001-01-20")),
    (("2001-01-10", "2001-01-20"), ("2001-01-01", "2001-03-01")), (("2001-01-10", "2001-01-10"), ("2001-01-10", "2001-01-15")),
])
def test_moved_counts_equal_a_full_count(spark, tmp_path, old, new):
    rng = random.Random(2)
    rows = [
        (rng.choice(["a", "b", None, ""]), rng.choice(["m", None]), FIRST + dt.timedelta(days=rng.randrange(60)) if rng.random() < 0.95 else None)
        for _ in range(800)
    ]
    df = spark.createDataFrame(rows, "name string, market string, as_of date")
    state = str(tmp_path / "days")
    half = F.col("as_of") < F.lit("2001-01-31").cast("date")
    for part in (df.filter(half), df.filter(~half), df.filter(half)):  # the first days again: nothing changes
        mw.store_days(mw.daily_counts(part, ["name", "market"]), state)
    before = mw.window_counts(mw.stored_days(spark, state, *old))
    got = {(r["name"], r["market"]): r["freq"] for r in mw.move(spark, before, state, old, new).collect()}
    want = {}
    for name, market, day in rows:
        if day is not None and new[0] <= str(day) < new[1]:
            want[name, market] = want.get((name, market), 0) + 1
    assert got == want


def test_only_days_of_one_window_are_read(spark, tmp_path):
    df = spark.createDataFrame([("a", FIRST + dt.timedelta(days=k)) for k in range(60)], "name string, as_of date")
    state = str(tmp_path / "days")
    mw.store_days(mw.daily_counts(df, ["name"]), state)
    before = mw.window_counts(mw.stored_days(spark, state, "2001-01-01", "2001-02-01"))
    moved = mw.move(spark, before, state, ("2001-01-01", "2001-02-01"), ("2001-01-03", "2001-02-03"))
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("2001-02-01") >= 1 and [r["freq"] for r in moved.collect()] == [31]
