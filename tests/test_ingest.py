"""Incremental ingest: late files of a sample, batches run again, and a crash between write and commit."""

import shutil

import pytest

from phylospark.streaming.ingest import ingest_new

SCHEMA = "sample string, hit_id long"


def held(spark, path):
    return sorted(tuple(x) for x in spark.read.parquet(path).select("sample", "hit_id").collect())


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_a_sample_in_two_batches_keeps_both(spark, tmp_path):
    base = str(tmp_path)
    for rows in ([("s1", 1), ("s2", 5)], [("s1", 2)], [("s3", 7), ("s1", 3)]):
        put(spark, f"{base}/in", rows)
        ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state")
    want = [("s1", 1), ("s1", 2), ("s1", 3), ("s2", 5), ("s3", 7)]
    assert held(spark, f"{base}/out") == want
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state")  # nothing new
    assert held(spark, f"{base}/out") == want
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/fresh")  # every batch again
    assert held(spark, f"{base}/out") == want
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/fresher", overwrite=True)
    assert held(spark, f"{base}/out") == want


def test_a_crash_between_write_and_commit_loses_nothing(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", [("s1", 1)])
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state")
    put(spark, f"{base}/in", [("s1", 2), ("s2", 3)])
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state")
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # written, but the batch was never marked as done
    (tmp_path / "state" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    shutil.rmtree(tmp_path / "out" / "sample=s2")  # of its folders one hadn't been moved into place yet
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state")
    assert held(spark, f"{base}/out") == [("s1", 1), ("s1", 2), ("s2", 3)]


def test_a_failed_batch_is_done_by_the_next_call(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", [("s1", 1)])

    def fails(batch):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state", transform=fails)
    ingest_new(spark, f"{base}/in", SCHEMA, f"{base}/out", f"{base}/state", transform=lambda b: b.where("hit_id > 0"))
    assert held(spark, f"{base}/out") == [("s1", 1)]
