"""Every registered query against its SQL; at a scale where rounding and ties show."""

import pytest

from compare import differences, duck
from notelake.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


@pytest.mark.parametrize("partitions", [1, 50])
@pytest.mark.parametrize("name", ["type_ratio", "ranked_calls", "notebook_metrics",
                                  "rebuilt_notebooks", "deduplicated_hits", "price_quartiles"])
def test_result_does_not_depend_on_partitions(spark, con, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
