"""Hits of more orders than 64-bit ids can number."""

import pytest

from phylospark.plans import q_similarity

FIELDS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"


@pytest.mark.parametrize("first", [0, 54_000_000])
def test_paths_and_stitched_hits_of_many_orders(spark, tmp_path, first):
    rows = [(first + 20 * i, 50 * i, i, 1 + i % 7, float(1 + i % 50), 1000.0 * (i % 9)) for i in range(300)]
    spark.createDataFrame(rows, FIELDS).write.parquet(str(tmp_path / "lineitem.parquet"))
    paths = q_similarity.greedy_paths(spark, str(tmp_path)).collect()
    assert sorted(int(r["hit_id"]) for r in paths) == sorted(o * 10**12 + n * 10**11 + p * 10**4 + s for o, p, s, n, *_ in rows)
    found = q_similarity.stitched_hits(spark, str(tmp_path)).collect()
    assert len(found) == len({r["path"] for r in paths}) and sum(r["contigs"] for r in found) == len(rows)
