"""Stored quantile sketches against plain ranks."""

import math
import random

import pytest

from visitmart.operators import sketches as K

SHARES = {"p01": 0.01, "p25": 0.25, "median": 0.5, "p99": 0.99, "most": 1.0}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    made = [(f"2024-{1 + k % 5:02d}", "a", round(r.gauss(k % 5, 2), 1 + k % 3)) for k in range(4000)]
    made += [("2024-02", "a", 1.5)] * 3000 + [("2024-01", "b", float(k)) for k in range(3)]
    return made + [(None, "a", 0.25), ("2024-01", "a", None), ("2024-03", None, 7.0)]


def check(rows, told, points):
    for row in told:
        values = sorted(v for _, kind, v in rows if kind == row.kind and v is not None)
        assert row.n == len(values) and row.rank_error == pytest.approx(len(values) / points)
        for name, share in SHARES.items():
            rank = max(1, math.ceil(share * len(values)))
            assert sum(v <= row[name] for v in values) >= rank
            assert sum(v < row[name] for v in values) < rank + row.rank_error


@pytest.mark.parametrize("points", [1, 20, 100_000])
def test_merged_months_keep_the_bound(spark, rows, points):
    df = spark.createDataFrame(rows, "month string, kind string, v double").repartition(5)
    sketch = K.rank_sketch(df, "v", ["month", "kind"], points)
    sizes = sketch.groupBy("month", "kind").count().collect()
    assert max(r["count"] for r in sizes) <= points
    told = K.sketch_quantiles(sketch, SHARES, ["kind"], points).collect()
    assert {r.kind for r in told} == {"a", "b", None}
    check(rows, told, points)
    none = K.rank_sketch(df.limit(0), "v", ["month", "kind"], points)
    assert none.count() == 0 and K.sketch_quantiles(none, SHARES, ["kind"], points).count() == 0


def test_a_month_is_replaced_alone(spark, rows, tmp_path):
    path = str(tmp_path / "sketches")
    dated = [x for x in rows if x[0]]
    schema = "month string, kind string, v double"
    K.write_sketches(K.rank_sketch(spark.createDataFrame(dated, schema), "v", ["month", "kind"], 20), path, "month")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    new = [("2024-03", "a", float(k)) for k in range(500)]
    K.write_sketches(K.rank_sketch(spark.createDataFrame(new, schema), "v", ["month", "kind"], 20), path, "month")
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert {p.parent.name for p in set(before) ^ set(after)} == {"month=2024-03"}
    assert all(after[p] == t for p, t in before.items() if p in after)
    now = [x for x in dated if x[0] != "2024-03"] + new
    check(now, K.sketch_quantiles(K.read_sketches(spark, path, "month"), SHARES, ["kind"], 20).collect(), 20)
    some = K.read_sketches(spark, path, "month", ["2024-01", "2024-03"])
    check([x for x in now if x[0] in ("2024-01", "2024-03")], K.sketch_quantiles(some, SHARES, ["kind"], 20).collect(), 20)
    files = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in files
