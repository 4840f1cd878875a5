"""Named files, one a locus: names and contents, retried tasks, failures."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from phylospark.sources import files

ROWS = [("L1", "b", "ACGTA", "two"), ("L1", "aaa", "AC-TA", ""), ("L2", "x", "TT", "one"), ("L3", "y", "", "")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "locus string, name string, sequence string, description string").repartition(3)


def listed(path):
    return sorted(os.listdir(path))


def text(path):
    with open(path) as f:
        return f.read()


def test_one_fasta_file_a_locus(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    files.write_fasta_files(rows, out, width=3)
    assert listed(out) == ["L1.fasta", "L2.fasta", "L3.fasta"]
    assert text(f"{out}/L1.fasta") == ">aaa\nAC-\nTA\n>b two\nACG\nTA\n" and text(f"{out}/L2.fasta") == ">x one\nTT\n"
    files.write_fasta_files(rows.where("locus = 'L2'").withColumn("locus", F.lit("L9")), out, suffix=".fasta.gz")  # the others go
    assert listed(out) == ["L9.fasta.gz"]
    with gzip.open(f"{out}/L9.fasta.gz", "rt") as f:
        assert f.read() == ">x one\nTT\n"


def test_nexus_files(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    files.write_nexus_files(rows, out, width=2)
    assert text(f"{out}/L1.nex") == (
        "#NEXUS\nBEGIN DATA;\nDIMENSIONS NTAX=2 NCHAR=5;\nFORMAT INTERLEAVE DATATYPE=DNA GAP=- MISSING=?;\nMATRIX\n"
        "aaa AC\nb   AC\n\naaa -T\nb   GT\n\naaa A\nb   A\n\n;\nEND;\n"
    )
    files.write_nexus_files(rows, out, kind="AA")
    assert text(f"{out}/L2.nex") == "#NEXUS\nBEGIN DATA;\nDIMENSIONS NTAX=1 NCHAR=2;\nFORMAT DATATYPE=PROTEIN GAP=- MISSING=?;\nMATRIX\nx TT\n;\nEND;\n"


def test_many_loci_over_many_tasks(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(3000).selectExpr("concat('L', id % 97) as locus", "concat('s', id) as name", "repeat('ACGT', 5) as sequence")
    files.write_fasta_files(rows, out)
    assert len(listed(out)) == 97
    got = sorted(x[1:] for f in listed(out) for x in text(f"{out}/{f}").split("\n") if x.startswith(">"))
    assert got == sorted(f"s{i}" for i in range(3000))


def test_attempts_that_do_not_count_leave_nothing(tmp_path):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"file": ["a", "a", "b"], "line": ["1", "2", "3"]})
    writer = files._Writer(str(tmp_path / "out"), True)
    writer.write(iter([batch]))  # a first attempt that was lost after it had written
    writer.commit([writer.write(iter([batch])), None])
    assert listed(tmp_path / "out") == ["a", "b"] and text(tmp_path / "out" / "a") == "1\n2\n"
    again = files._Writer(str(tmp_path / "out"), False)
    again.write(iter([batch]))
    again.abort([None])
    assert listed(tmp_path / "out") == ["a", "b"]
    twice = files._Writer(str(tmp_path / "out"), False)
    with pytest.raises(ValueError, match="several tasks"):
        twice.commit([twice.write(iter([batch])), twice.write(iter([batch]))])
    apart = pa.RecordBatch.from_pydict({"file": ["a", "b", "a"], "line": ["1", "2", "3"]})
    with pytest.raises(ValueError, match="together"):
        twice.write(iter([apart]))
