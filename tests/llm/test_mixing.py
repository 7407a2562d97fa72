import pytest

from tallyhouse.llm import mixing
from tallyhouse.llm.queries import op4_mix_sources


def fill(sizes, weights, amount, limit):
    """Targets by resharing the excess round after round."""
    targets, full = dict.fromkeys(sizes, 0.0), set()
    while True:
        rest = amount - sum(limit * sizes[s] for s in full)
        total = sum(weights[s] for s in sizes if s not in full)
        targets = {s: limit * sizes[s] if s in full else weights[s] * rest / total for s in sizes}
        above = {s for s in sizes if s not in full and targets[s] >= limit * sizes[s]}
        if not above:
            return targets
        full |= above


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 7, "d": 0}, {"z": 10}, {"a": 5, "B": 900, "é": 40, "c": 3},
])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    found = mixing.source_rates(spark.createDataFrame(rows, "source string, size long"), [3, 1, 2], 150, 2).collect()
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert {r["source"]: r["target"] for r in found} == pytest.approx(want)
    assert all(r["rate"] <= 2 for r in found)


def test_copies_come_near_the_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "10L AS size")
    rates = mixing.source_rates(docs.select("source", "size"), [3, 1, 2], 150, 2)
    for broadcast in (True, False):
        taken = {r["source"]: r["n"] for r in mixing.mix(docs, rates, broadcast=broadcast).groupBy("source").agg({"size": "sum"})
                 .toDF("source", "n").collect()}
        for row in rates.collect():
            assert abs(taken[row["source"]] - row["target"]) < 0.03 * row["source_size"]


def test_odd_rows(spark, folders):
    rows = op4_mix_sources(spark, folders["odd"]).collect()
    assert all(r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
    again = op4_mix_sources(spark, folders["odd"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert {r["size"] for r in rows if r["doc_id"] in (0, 1, 2)} == {0}
