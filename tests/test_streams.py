"""Groups stay whole in a stream, whatever the plan makes of exchanges before it."""

import pytest
from pyspark.sql import functions as F

from phylospark.operators import grouped, merge, sites


@pytest.fixture
def late_broadcast(spark):
    """Joins that are planned as sorted ones and become broadcasts when the sizes are known."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _rows(spark, loci=3, rows=40):
    data = [(f"L{n}", f"q{i}", f"s{i % 5}", False, "NT", "ACGTACGT"[i % 4 :] + "----"[: i % 4]) for n in range(loci) for i in range(rows)]
    return spark.createDataFrame(data, "locus string, seq_name string, sample string, is_ref boolean, format string, sequence string").repartition(6)


def test_a_file_has_one_row_of_statistics(late_broadcast):
    found = merge.file_statistics(_rows(late_broadcast), ["locus"]).collect()
    assert sorted((r["locus"], r["sequences"], r["patterns"]) for r in found) == [(f"L{n}", 40, 7) for n in range(3)]


def test_groups_stay_whole_after_a_join_on_their_keys(late_broadcast):
    rows = _rows(late_broadcast)
    joined = rows.join(rows.groupBy("locus").agg(F.count(F.lit(1)).alias("n")), "locus")
    assert sorted((r["locus"], r["patterns"]) for r in sites.column_patterns(joined, ["locus"], "seq_name").collect()) == [(f"L{n}", 7) for n in range(3)]
    hits = joined.select("locus", F.substring("seq_name", 2, 9).cast("long").alias("hit_id"), F.lit("wedged").alias("region"), F.lit(0.5).alias("wscore"), F.lit(90.0).alias("identity"), F.lit(0).cast("long").alias("q_start"), F.lit(200).cast("long").alias("q_end"))
    paths = grouped.greedy_paths(hits, ["locus"])
    assert paths.select("locus", "path").distinct().count() == 3 * 40  # each overlaps all others, so each has a path of its own
