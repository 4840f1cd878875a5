"""K-mers of contigs that targets have too: all of them, whatever their letters and lengths, and few others."""

import random

import pytest

from phylospark.operators import similarity

r = random.Random(8)


def text(n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


@pytest.mark.parametrize("step, letters", [(1, 1 << 20), (5, 1 << 20), (1, 150), (5, 150)])
def test_all_wanted_kmers_come_and_few_others(spark, monkeypatch, step, letters):
    monkeypatch.setattr(similarity, "LETTERS", letters)
    wanted = [text(300), text(60, "ACGTNÄ\U0001f600"), "acgtacgtacg", "AC", "", None]
    contigs = [text(1000), wanted[0][40:200].lower() + text(700), text(33) + wanted[1], "ACGTACGTACG", "ACG", "", None, text(11), wanted[0] * 3]
    frame = spark.createDataFrame([(str(i), s) for i, s in enumerate(contigs)], "contig string, sequence string")
    targets = spark.createDataFrame([(s,) for s in wanted], "sequence string")
    held = {x.upper()[i : i + 11] for x in wanted if x for i in range(len(x) - 10)}
    every = {(str(c), i + 1, s.upper()[i : i + 11]) for c, s in enumerate(contigs) if s for i in range(0, len(s) - 10, step)}
    got = similarity.kmers_among(frame, ["contig"], 11, targets, step)
    rows = [tuple(x) for x in got.collect()]
    assert len(rows) == len(set(rows)) and {x for x in every if x[2] in held} <= set(rows) <= every
    assert sum(x[2] not in held for x in rows) < 40
    assert got.schema == similarity.kmers(frame, ["contig"], 11, step).schema or [f.dataType for f in got.schema] == [f.dataType for f in similarity.kmers(frame, ["contig"], 11, step).schema]


def test_only_kmers_of_targets_are_shuffled(spark):
    contigs = spark.createDataFrame([(str(i), text(2000)) for i in range(40)], "contig string, sequence string")
    targets = spark.createDataFrame([("t", text(100))], "target string, sequence string")
    assert similarity.kmers_among(contigs, ["contig"], 21, targets).count() < 40 * 1980 / 100
    plan = similarity.seed_hits(targets, contigs, k=21)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
