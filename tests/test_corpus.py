"""Files to statistics in one go, checked against the cells that went in."""

import json
import random

from notelake.plans.corpus import build_corpus
from notelake.plans.fixtures import (
    CELL_CASES, MPL_OPS, PANDAS_OPS, SEABORN_OPS, UNPARSABLE_CASES, functions_table, pandas_vocab,
    part_trees,
)
from notelake.schemas import METRICS, OP_COUNTS, PEAK_METRICS
from notelake.sources.tables import read_csv_table


def test_corpus(spark, tmp_path):
    rng = random.Random(9)
    chosen = {}
    for i in range(12):
        picks = [rng.randrange(len(CELL_CASES)) for _ in range(rng.randrange(1, 9))]
        chosen[f"{i}.ipynb"] = picks
        cells = [c for k in picks for c in (
            {"cell_type": "code", "source": CELL_CASES[k][0].splitlines(keepends=True)},
            {"cell_type": "markdown", "source": "text"})]
        folder = tmp_path / "in" / f"d{i % 3}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.ipynb").write_text(json.dumps({"cells": cells}))
    out = str(tmp_path / "out")
    links = spark.createDataFrame([(i, f"https://github.com/o/r{i % 3}") for i in range(5)] + [(9, "x")],
                                  "seq long, repo_url string")
    responses = part_trees(spark, "/root/testdata/sf0.001").where("repo_name = 'o/r1'")
    counted = build_corpus(
        spark, str(tmp_path / "in"), out, pandas_vocab(spark), functions_table(spark, MPL_OPS),
        functions_table(spark, SEABORN_OPS), links=links, responses=responses)
    n = sum(map(len, chosen.values()))
    failed = sum(k in UNPARSABLE_CASES for picks in chosen.values() for k in picks)
    assert counted == {"code": n, "markdown": n, "total_rows": n, "parse_errors": failed}
    sizes = {r.name: int(r.value) for r in spark.read.option("header", True).csv(
        f"{out}/corpus_sizes.csv").collect()}
    assert sizes["notebooks"] == len(chosen) and sizes["repositories"] == 3
    assert sizes["csv_files"] == spark.read.parquet(f"{out}/csv_files").count()

    rolled = {r.notebook_hash.split("/")[1]: r
              for r in spark.read.parquet(f"{out}/notebook_metrics").collect()}
    for name, picks in chosen.items():
        values = [CELL_CASES[k][1] for k in picks]
        assert rolled[name].n_cells == len(picks)
        for m in METRICS:
            fold = max if m in PEAK_METRICS else sum
            assert rolled[name][m] == fold(v.get(m, 0) for v in values), (name, m)
    counts = {r.function: r["count"] for r in read_csv_table(
        spark, f"{out}/pandas_ops_count.csv", OP_COUNTS).collect()}
    used = [k for picks in chosen.values() for k in picks]
    assert counts == {f: sum(CELL_CASES[k][2].get(f, 0) for k in used) for f in PANDAS_OPS}
    stats = spark.read.option("header", True).csv(f"{out}/statistics.csv")
    assert stats.count() == 2 * len(METRICS) + 1
    ratio = spark.read.option("header", True).csv(f"{out}/type_ratio.csv").collect()
    assert len(ratio) == 100 and all(
        int(r.text_count) + int(r.code_count) == len(chosen) for r in ratio)
    assert spark.read.option("header", True).csv(f"{out}/position_curves.csv").count() == 300
    ranked = {r.function: r for r in spark.read.option("header", True).csv(
        f"{out}/call_ranking.csv").collect()}
    assert {f: int(r["count"]) for f, r in ranked.items()} == counts
    peak = max(sorted(rolled.values(), key=lambda r: r.notebook_hash), key=lambda r: r.PO)
    cells = spark.read.parquet(f"{out}/peak_notebook").collect()
    assert {c.notebook_hash for c in cells} == {peak.notebook_hash} and len(cells) == peak.n_cells
    assert spark.read.option("header", True).csv(f"{out}/chain_lengths.csv").count() == 2
    assert spark.read.option("header", True).csv(f"{out}/cells_per_notebook_fences.csv").count() == 1
