"""Nearest vectors against brute force; codes, bounds and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from notelake.llm import one_bit

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, every, k=5):
    """{(query, rank): (id, cosine)} of rows with different ids."""
    good = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, a in good.items():
        if q % every:
            continue
        scored = [(-float(one_bit.exact(a[None], b[None])[0]), i) for i, b in good.items()
                  if i != q and len(a) == len(b)]
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            out[q, rank] = (i, -score)
    return out


def found(spark, rows, every, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as label", "2 as x", "3 as score", "4 as code", "5 as rank")
    result = one_bit.nearest(frame, every, **options).collect()
    assert len({(r.query_id, r.rank) for r in result}) == len(result)
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in result}


def test_by_brute_force_with_groups(spark):
    rng = np.random.default_rng(1)
    single = rng.standard_normal((600, 24)).astype(np.float32)
    copies = np.repeat(single[:1], 200, axis=0)
    near = single[1] + 0.02 * rng.standard_normal((300, 24)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([single, copies, near]))]
    rng.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    assert found(spark, rows, 10) == plain(rows, 10)
    assert found(spark, rows, 10, block=16, k=3) == plain(rows, 10, 3)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]),
            (20, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (30, [-3e38, 1e-40])]
    wanted = plain(rows, 10)
    assert found(spark, rows, 10) == wanted
    assert {q for q, _ in wanted} == {0, 10, 30}
    assert found(spark, [*rows, (1, [2.0, 0.0]), (0, [1.0, 0.0])], 10) == wanted  # repeated rows
    two = found(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 1.0])], 10)
    assert [i for i, _ in two.values()] == [1]
    assert found(spark, rows[:1], 10) == {} == found(spark, [], 10)


def test_recall_and_scores_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    result = {(r.query_id, r["rank"]): (r.vec_id, r.score)
              for r in one_bit.nearest(frame, 50).collect()}
    wanted = plain(rows, 50)
    assert sum(result[q] == w for q, w in wanted.items()) >= 0.9 * len(wanted)
    assert result == wanted
    assert one_bit.nearest(frame.where(F.col("vec_id") % 50 != 0), 50).collect() == []


@pytest.mark.parametrize("width", [1, 3, 64, 300])
def test_bounds_hold_and_prune(width):
    rng = np.random.default_rng(2)
    data, queries = rng.standard_normal((2, 400, width))
    codes, own = one_bit.encode(data)
    turned = one_bit.unit(queries).astype(np.float32) @ one_bit.rotation(width)
    upper = one_bit.upper_bounds(codes, own, turned)
    cosine = one_bit.unit(data) @ one_bit.unit(queries).T
    assert (upper >= cosine).all()
    assert codes.shape[1] * 8 == one_bit.code_bits(width) and codes.shape[1] * 8 >= 256
    if width == 64:
        assert (upper >= 0.4).mean() < 0.3
