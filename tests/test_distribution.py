import random
from collections import Counter
from statistics import median as plain_median

from pyspark.sql import functions as F

from tallyhouse.operators.distribution import distinct_count, median, with_mode, with_positions


def test_median_and_mode_against_plain_python(frame):
    rng = random.Random(3)
    data = [(g, rng.choice([None, 1, 2, 2, 5, 9])) for g in [1, 2, None] for _ in range(rng.randint(1, 40))] + [(7, None), (8, 4), (8, 9)]
    df = frame(data, "g int, v int")
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    found = with_positions(counted, ["g"], "v", "n").groupBy("g").agg(median("v").alias("median"))
    modes = with_mode(counted, ["g"], "v", "n", "mode").groupBy("g").agg(F.max("mode").alias("mode"))
    values = {g: [v for k, v in data if k == g and v is not None] for g in {g for g, _ in data}}
    assert {r["g"]: r["median"] for r in found.collect()} == {g: float(plain_median(v)) if v else None for g, v in values.items()}
    want = {g: min(Counter(v), key=lambda x, c=Counter(v): (-c[x], x)) if v else None for g, v in values.items()}
    assert {r["g"]: r["mode"] for r in modes.collect()} == want
    distinct = {r["g"]: r["d"] for r in distinct_count(df, ["g"], "v", "d").collect()}
    assert distinct == {g: len(set(v)) for g, v in values.items()}


def test_no_object_aggregate(frame):
    counted = frame([(1, 2, 3)], "g int, v int, n long")
    plan = with_positions(counted, ["g"], "v", "n").groupBy("g").agg(median("v"))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "Expand" not in plan
