"""Ordered plans against a sequential walk, for bucket widths from one row to everything."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from quirework.plans.anchored import anchored_runs
from quirework.plans.ordered import (
    Following, GroupLast, GroupMax, GroupSum, LastKnown, MaxBefore, Previous, RowNumber, RunningSum, id_bucket, ordered_scan,
)


def series(seed, size=300):
    rng = random.Random(seed)
    # Key "hot" holds most rows.
    return [
        (rng.choice(["hot", "hot", "hot", "a", "b"]), i, rng.randint(-5, 50), rng.choice([None, rng.randint(0, 9)])) for i in range(size)
    ]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_scan_steps(spark, width):
    data = series(width)
    df = spark.createDataFrame(data, "k string, i long, v long, w long").repartition(5)
    v, w = F.col("v"), F.col("w")
    out = ordered_scan(
        df, ["k"], id_bucket("i", width), ["i"],
        RowNumber("n"), RunningSum("s", v), MaxBefore("m", v), LastKnown("l", w), Previous("p", w), Following("f", w),
        GroupSum("gs", v), GroupMax("gm", v), GroupLast("gl", w),
    )
    got = {(r.k, r.i): tuple(r[4:]) for r in out.collect()}
    want = {}
    for key in {d[0] for d in data}:
        rows = [d for d in data if d[0] == key]
        last = None
        for at, (k, i, x, y) in enumerate(rows):
            last = y if y is not None else last
            known = [d[3] for d in rows if d[3] is not None]
            want[k, i] = (
                at + 1,
                sum(d[2] for d in rows[: at + 1]),
                max((d[2] for d in rows[:at]), default=None),
                last,
                rows[at - 1][3] if at else None,
                rows[at + 1][3] if at + 1 < len(rows) else None,
                sum(d[2] for d in rows),
                max(d[2] for d in rows),
                known[-1] if known else None,
            )
    assert got == want


def walk(rows, limit):
    """(start, end) rows in order -> run numbers."""
    run, anchor, out = 0, None, []
    for start, end in rows:
        if anchor is None or end > anchor + limit:
            run, anchor = run + 1, start
        out.append(run)
    return out


@pytest.mark.parametrize("width", [1, 13, 10_000])
@pytest.mark.parametrize("limit", [0, 9, 120])
def test_anchored_runs(spark, width, limit):
    rng = random.Random(width * 1000 + limit)
    data, want = [], {}
    for key in ("hot", "x", "y"):
        at = 0
        rows = []
        for i in range(200 if key == "hot" else 30):
            at += rng.choice([0, 0, 1, 2, 5, 40])
            rows.append((at, i))
        for (t, i), run in zip(rows, walk([(t, t) for t, _ in rows], limit)):
            data.append((key, i, t, 2**60 + i))
            want[key, i] = (run, 2**60 + i)
    df = spark.createDataFrame(data, "k string, i long, t long, wide long").repartition(4)
    out = anchored_runs(df, ["k"], F.floor(F.col("t") / width), ["t", "i"], F.col("t"), F.col("t"), limit)
    assert {(r.k, r.i): (r.run, r.wide) for r in out.collect()} == want


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_packing(spark, width):
    from quirework.operators.batches import pack

    rng = random.Random(width)
    sizes = [rng.choice([1, 10, 90, 500, 3000]) for _ in range(250)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, s long").repartition(6)
    out = {r.i: r.chunk for r in pack(df, [], id_bucket("i", width), ["i"], F.col("s"), capacity=1000, overhead=80).collect()}
    chunk, fill, want = 1, 0, {}
    for i, s in enumerate(sizes):
        if fill and fill + s + 80 > 1000:
            chunk, fill = chunk + 1, 0
        fill += s + 80
        want[i] = chunk
    assert out == want


def test_pack_never_exceeds_capacity_unless_single(spark):
    from quirework.operators.batches import pack

    df = spark.range(500).withColumn("s", (F.col("id") * 37) % 400)
    packed = pack(df, [], id_bucket("id", 50), ["id"], F.col("s"), capacity=600, overhead=10)
    over = packed.groupBy("chunk").agg(F.sum(F.col("s") + 10).alias("t"), F.count("*").alias("n")).filter("t > 600 AND n > 1")
    assert over.count() == 0


# Queries whose builders run jobs are planned too: what they return is checked.
def test_no_pairwise_plans(spark):
    bad = {}
    for name, query in entry_points.queries().items():
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        hits = [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin") if n in plan]
        if hits:
            bad[name] = hits
    assert not bad


def test_top_per_group_limits_before_the_shuffle(spark):
    plan = entry_points.queries()["per_group_top5"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "WindowGroupLimit" in plan


def test_scans_read_only_what_they_need(spark):
    plan = entry_points.queries()["ind_vwap"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    plan = entry_points.queries()["label_semi_docs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(quality,1)" in plan
