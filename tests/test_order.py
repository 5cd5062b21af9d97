"""Positions, ranks, curves and quantiles against direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notelake.operators import aggregates as agg, position, quantiles, ranking
from notelake.operators.ordering import global_index, number_in_notebook
from notelake.operators.quantiles import exact_quantiles


def skewed_cells(spark):
    """One notebook holds most cells, with gaps; many are tiny."""
    rng = random.Random(1)
    rows = [("hot", p, rng.randrange(2)) for p in sorted(rng.sample(range(3000), 900))]
    rows += [(f"n{i}", p, rng.randrange(2)) for i in range(60) for p in range(1 + i % 9)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "notebook_hash string, cell_pos int, flag int")


@pytest.mark.parametrize("block", [1, 7, 100, 4096])
def test_numbers_in_group(spark, block):
    rows, df = skewed_cells(spark)
    found = number_in_notebook(df, block=block).collect()
    wanted = {}
    for name in {r[0] for r in rows}:
        own = sorted(p for n, p, _ in rows if n == name)
        wanted.update({(name, p): (i, len(own)) for i, p in enumerate(own)})
    assert {(r.notebook_hash, r.cell_pos): (r.position, r.n_cells) for r in found} == wanted


@pytest.mark.parametrize("bins", [100, 7])
def test_curves_match_sampling(spark, bins):
    rows, df = skewed_cells(spark)
    code, md = df.where("cell_pos % 3 > 0"), df.where("cell_pos % 3 = 0")
    hits, text = np.zeros(bins, int), np.zeros(bins, int)
    names = {r[0] for r in rows}
    for name in names:
        own = sorted((p, f) for n, p, f in rows if n == name)
        at = np.arange(bins) * len(own) // bins
        hits += np.array([f if p % 3 else 0 for p, f in own])[at]
        text += np.array([p % 3 == 0 for p, _ in own])[at]
    curve = {r.bin: r for r in position.position_curve(code, md, "flag", bins).collect()}
    ratio = {r.bin: r for r in position.type_ratio_curve(code, md, bins).collect()}
    for b in range(bins):
        assert (curve[b].hits, curve[b].notebooks) == (hits[b], len(names))
        assert curve[b].pct == pytest.approx(hits[b] / len(names) * 100)
        assert (ratio[b].text_count, ratio[b].code_count) == (text[b], len(names) - text[b])
    median = position.curve_median(position.type_ratio_curve(code, md, bins)).first()[0]
    assert median == pytest.approx(np.median(text / len(names) * 100))


def test_curve_without_positions_orders_ids_by_number(spark):
    _, df = skewed_cells(spark)
    ids = df.select("notebook_hash", F.col("cell_pos").cast("string").alias("cell_id"), "flag")
    a = position.position_curve(df, df.limit(0), "flag").orderBy("bin").collect()
    b = position.position_curve(ids, ids.limit(0), "flag").orderBy("bin").collect()
    assert a == b


def test_three_cells_cover_all_bins(spark):
    code = spark.createDataFrame([("n", 0, 1), ("n", 2, 0)],
                                 "notebook_hash string, cell_pos int, I int")
    md = spark.createDataFrame([("n", 1)], "notebook_hash string, cell_pos int")
    rows = position.type_ratio_curve(code, md).orderBy("bin").collect()
    assert [r.text_count for r in rows] == [0] * 34 + [1] * 33 + [0] * 33
    rows = position.position_curve(code, md, "I").orderBy("bin").collect()
    assert [r.hits for r in rows] == [1] * 34 + [0] * 66


def test_global_index(spark):
    df = spark.range(1000, numPartitions=7).withColumn("v", F.expr("id * 37 % 100"))
    rows = global_index(df, [F.desc("v"), F.col("id")]).orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(1000))
    assert [(r.v, r.id) for r in rows] == sorted(
        ((r.v, r.id) for r in rows), key=lambda t: (-t[0], t[1]))
    assert global_index(df.limit(0), [F.col("id")]).count() == 0


def test_ranks(spark):
    ops = spark.createDataFrame([("b", 3), ("a", 3), ("c", 9), ("d", 0)],
                                "function string, count long")
    assert [r.function for r in ranking.rank_ops(ops).orderBy("rank").collect()] == list("cabd")
    assert [r.function for r in ranking.top_k(ops, "count", 2, ["function"]).collect()] == ["c", "a"]
    assert [r.function for r in ranking.bottom_k(ops, "count", 2, ["function"]).collect()] == [
        "d", "b"]


P = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def test_quantiles(spark):
    rng = random.Random(2)
    columns = {
        "spread": [rng.gauss(0, 1e6) for _ in range(5000)],
        "tied": [float(rng.choice([0, 0, 0, 0, 1, 2, 50])) for _ in range(5000)],
        "same": [3.0] * 5000,
        "outlier": [rng.random() for _ in range(4999)] + [1e300],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).withColumn(
        "counter", F.col("tied").cast("int"))
    cols = [*columns, "counter"]
    found = exact_quantiles(df, cols, P)
    for c in cols:
        data = columns.get(c, columns["tied"])
        assert found[c] == pytest.approx(list(np.quantile(data, P)), rel=1e-12), c


def test_quantiles_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, None), (4.0, None), (None, None)], "a double, b double")
    found = exact_quantiles(df, ["a", "b"], (0.25, 0.5))
    assert found == {"a": [1.75, 2.5], "b": [None, None]}


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (nan,), (3.0,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], (0.0, 0.5, 1.0)) == {"x": [1.0, 2.0, 3.0]}
    row = agg.describe(df, ["x"], 2).first()
    assert (row["count"], row["mean"], row["std"], row["max"]) == (2, 2.0, 1.41, 3.0)
    infinite = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    assert agg.describe(infinite, ["x"], 2).first()["max"] == float("inf")


def test_infinite_quantiles_are_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, inf, inf, inf)], "x double")
    assert exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.75, 1.0))["x"] == [1.0, 2.0, inf, inf, inf]


def test_quantiles_gather_no_buffers(spark):
    import inspect

    from notelake.operators import quantiles

    assert "percentile" not in inspect.getsource(quantiles)


def test_missing_positions_lose_no_cell(spark):
    """Given positions first, then ids that are numbers, then other ids, in every notebook."""
    rows = [("a", 5, "x"), ("a", 2, "y"), ("a", None, "10"), ("a", None, "9"), ("a", None, "zz"),
            ("a", None, "b"), ("a", None, None), (None, None, "1"), (None, 0, "2")]
    df = spark.createDataFrame(rows, "notebook_hash string, cell_pos int, cell_id string")
    for block in (1, 4096):
        found = {(r.notebook_hash, r.cell_pos, r.cell_id): (r.position, r.n_cells)
                 for r in number_in_notebook(df, block=block).collect()}
        wanted = [("a", 2, "y"), ("a", 5, "x"), ("a", None, "9"), ("a", None, "10"),
                  ("a", None, None), ("a", None, "b"), ("a", None, "zz")]
        assert found == {k: (i, 7) for i, k in enumerate(wanted)} | {
            (None, 0, "2"): (0, 2), (None, None, "1"): (1, 2)}


def test_describe_matches_pandas(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.randrange(40), rng.random()) for _ in range(501)],
                               "n int, x double")
    wanted = df.toPandas().describe()
    stats = {r["column"]: r for r in agg.describe(df, ["n", "x"]).collect()}
    for c in ("n", "x"):
        found = [stats[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert found == pytest.approx(list(wanted[c]), rel=1e-9)
    wide = {r.statistic: r for r in agg.describe_wide(df, ["n", "x"], 2).collect()}
    assert wide["std"].x == round(wanted["x"]["std"], 2)


def test_histogram_matches_numpy(spark):
    rng = random.Random(6)
    for values in ([rng.randrange(1, 30) for _ in range(400)], [0] * 5 + [9], [4] * 6, [2, 4]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        counts, edges = np.histogram(values, bins=max(values))
        rows = {r.bin: r for r in agg.histogram(df, "v").collect()}
        assert {b: r.n for b, r in rows.items()} == {
            i: n for i, n in enumerate(counts) if n}, values
        for b, r in rows.items():
            assert (r.left, r.right) == pytest.approx((edges[b], edges[b + 1]))
    assert agg.histogram(spark.createDataFrame([(0,)], "v int"), "v").count() == 0


def test_histogram_edges_fall_as_in_numpy(spark):
    rng = random.Random(8)
    for _ in range(12):
        low, high = sorted(rng.sample(range(1, 200), 2))
        values = list(range(low, high + 1))
        counts, _ = np.histogram(values, bins=high)
        df = spark.createDataFrame([(v,) for v in values], "v int")
        rows = {r.bin: r.n for r in agg.histogram(df, "v").collect()}
        assert rows == {i: n for i, n in enumerate(counts) if n}, (low, high)


def test_shares_and_ratios(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 2, 1), ("c", 0, 0)], "f string, n long, d long")
    assert [r.percentage for r in agg.share_of_total(df, "n").orderBy("f").collect()] == [
        33.33, 66.67, 0.0]
    assert tuple(agg.mean_ratio(df, "n", "d").first()) == (2, 1.25)


def test_quantiles_of_extreme_values(spark):
    """Values next to powers of two, subnormal, huge, negative and infinite ones, on the bit."""
    inf = float("inf")
    rng = random.Random(6)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, inf, -inf,
              1.7976931348623157e308, -1.7976931348623157e308]
    for e in range(-1070, 1024, 7):
        for x in (2.0**e, np.nextafter(2.0**e, 0), np.nextafter(2.0**e, inf)):
            values += [float(x), -float(x)]
    values += [rng.uniform(0.1, 0.1000001) for _ in range(500)] + [0.3] * 700
    rng.shuffle(values)
    df = spark.createDataFrame([(x,) for x in values], "x double")
    n = len(values)
    wanted = sorted(values)
    ranks = set(range(0, n, 37)) | {0, n - 1}
    found = quantiles._values_at(df, {"x": ranks})
    assert {r: found["x", r] for r in ranks} == {r: wanted[r] for r in ranks}


def test_quantiles_sort_no_values_and_stop_early(spark):
    """Whole numbers and repeated values take two passes; at most four are ever needed."""
    df = spark.range(20_000).selectExpr("id % 50 as a", "id as b", "cast(id as double) / 7 as c")
    passes, kind = [], type(df)
    real = kind.collect
    try:
        kind.collect = lambda self: passes.append(self) or real(self)
        found = exact_quantiles(df, ["a"], (0.25, 0.5))
        assert found == {"a": [12.0, 24.5]} and len(passes) == 2
        passes.clear()
        exact_quantiles(df, ["a", "b", "c"], (0.25, 0.5, 0.75))
        assert len(passes) <= 4
    finally:
        kind.collect = real
    text = passes[-1]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text
