import math
import random

import pytest
from pyspark.sql import functions as F

from cierre.llm import topk


def brute(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(good):
        if q % 50 == 0:
            cut = lambda s: max(-(2**63), min(2**63 - 1, s))
            found = sorted((-cut(sum(x * y for x, y in zip(a, b))), c) for m, (c, b) in enumerate(good) if m != n and len(a) == len(b))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    make = lambda d: [rng.choice([rng.uniform(-1, 1), 0.5, -0.25]) for _ in range(d)]
    out = [(i, make(24)) for i in range(300)]
    out += [(900 + i, list(out[3][1])) for i in range(60)]  # ties
    out += [(50, make(24)), (100, list(out[100][1])), (None, make(24)), (350, None), (400, [1.0, None]), (450, [float("nan")] * 24),
            (500, [float("inf")] * 24), (550, make(3)), (551, make(3)), (600, []), (601, []), (650, [1e30] * 24), (651, [-1e30] * 24)]
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    return df.selectExpr("*", "1 AS id", "2 AS row", "3 AS dim", "4 AS score", "5 AS rank")


def test_matches_brute_force(spark, rows, monkeypatch):
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_fewer_candidates_than_k_and_empty_table(spark):
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5])]
    assert sorted(map(tuple, topk.top_k(frame(spark, few), F.col("vec_id") % 50 == 0).collect())) == brute(few)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []


def test_many_blocks_and_query_groups(spark, rows, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS_PER_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_no_join_on_the_length_alone(spark, rows):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "[dim#" in joins[0] and "part#" in joins[0]
