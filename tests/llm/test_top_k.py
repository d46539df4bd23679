"""Exact top-k search against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.pivot_search import top_inner_products

SCHEMA = "vec_id long, embedding array<float>, label int, position int, part string"


def brute(rows, is_query, top=20):
    whole = []
    for vec_id, vector, *_ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole.append((vec_id, [math.floor(64 * x) for x in vector]))
    out = []
    for query_id, q in whole:
        if query_id is None or not is_query(query_id):
            continue
        found = [(-sum(a * b for a, b in zip(q, v)), i is None, i or 0) for i, v in whole if i != query_id and len(v) == len(q)]
        found.sort()
        out += [(query_id, k, None if no_id else i, -s) for k, (s, no_id, i) in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def as_floats(rows, spark):
    return [(r.vec_id, r.embedding) for r in vectors(spark, rows).collect()]


@pytest.mark.parametrize("part_rows", [1 << 16, 37])
def test_random_vectors_in_clusters(spark, part_rows):
    draw = random.Random(part_rows)
    centres = [[draw.gauss(0, 3) for _ in range(6)] for _ in range(5)]
    rows = [(k, [x + draw.gauss(0, 0.2) for x in draw.choice(centres)]) for k in range(300)]
    rows += [(1000 + k, [1.0] * 6) for k in range(150)]  # one vector a third of all rows
    found = top_inner_products(vectors(spark, rows), F.col("vec_id") % 20 == 0, part_rows=part_rows)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(found) == brute(as_floats(rows, spark), lambda i: i % 20 == 0)


@pytest.mark.parametrize("part_rows", [1 << 16, 3])
def test_odd_rows(spark, part_rows):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (20, [0.5, -0.25]), (20, [0.1, 0.1]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]),
        (120, [1.0, 2.0, 3.0]), (140, []), (1, []), (3, [0.0, 0.0]), (3, [0.0, 0.0]), (None, [0.5, -0.25]), (None, [9.0, 9.0]),
        (-20, [1e-3, -1e-3]), (5, [3.0, 2.0, 1.0]), (160, [2.0**40, 1.0]), (7, [2.0**30, 2.0**20]),
    ]
    found = top_inner_products(vectors(spark, rows), F.col("vec_id") % 20 == 0, part_rows=part_rows)
    clip = lambda r: (*r[:3], max(-(2**63), min(2**63 - 1, r[3])))
    assert got(found) == sorted(map(clip, brute(as_floats(rows, spark), lambda i: i % 20 == 0)), key=str)


def test_no_rows_and_no_queries(spark):
    rows = vectors(spark, [(1, [1.0]), (2, [2.0])])
    assert got(top_inner_products(rows, F.col("vec_id") % 20 == 0)) == []
    assert got(top_inner_products(rows.where("false"), F.col("vec_id") % 20 == 0)) == []
