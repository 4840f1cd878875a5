"""Gapped search against full dynamic programs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phylospark.operators import gapped

r = random.Random(3)
LOW = -(10**9)


def letters(s):
    return np.frombuffer(s.encode(), np.uint8)


def full_score(q, t, whole):
    """The best affine alignment of two strings, from end to end or of any parts, by the whole table."""
    h = [[LOW if whole else 0] * (len(t) + 1) for _ in range(len(q) + 1)]
    e, f, best = [x[:] for x in h], [x[:] for x in h], 0
    for i in range(len(q) + 1):
        for j in range(len(t) + 1):
            e[i][j] = max(h[i][j - 1] - 3, e[i][j - 1] - 1) if j else LOW
            f[i][j] = max(h[i - 1][j] - 3, f[i - 1][j] - 1) if i else LOW
            straight = h[i - 1][j - 1] + (1 if q[i - 1] == t[j - 1] else -1) if i and j else 0 if i == j else LOW
            h[i][j] = max(straight, e[i][j], f[i][j], LOW if whole else 0)
            best = max(best, h[i][j])
    return h[-1][-1] if whole else best


def changed(s, rate):
    out, i = [], 0
    while i < len(s):
        x = r.random()
        if x < rate:
            out.append(r.choice("ACGT"))
        elif x < 1.3 * rate and x >= 1.15 * rate:
            out.append(s[i] + "".join(r.choice("ACGT") for _ in range(r.randint(1, 6))))
        elif x < 1.35 * rate and x >= 1.3 * rate:
            i += r.randint(1, 8)
            continue
        elif x >= 1.15 * rate:
            out.append(s[i])
        i += 1
    return "".join(out)


def dna(n):
    return "".join(r.choice("ACGT") for _ in range(n))


def reversed_(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_band_equals_the_whole_table():
    for _ in range(200):
        q, t = ("".join(r.choice("ACG") for _ in range(r.randint(1, 12))) for _ in range(2))
        score, blocks = gapped.banded(letters(q), letters(t), -12, 12, True)
        cost, a, b = 0, 0, 0
        for x, y, n in [*blocks, (len(q), len(t), 0)]:
            cost += (2 + x - a) * (x > a) + (2 + y - b) * (y > b) - sum(1 if q[x + k] == t[y + k] else -1 for k in range(n))
            a, b = x + n, y + n
        assert score == full_score(q, t, True) == -cost


def consistent(row, q, t):
    """A row's counts and blocks are those of the two sequences."""
    own = reversed_(q) if row["strand"] == "-" else q
    blocks = list(zip(row["q_starts"], row["t_starts"], row["block_sizes"], strict=True))
    same = sum(own[a + k] == t[b + k] for a, b, n in blocks for k in range(n))
    assert (row["matches"], row["mismatches"], row["block_count"]) == (same, sum(row["block_sizes"]) - same, len(blocks))
    gaps = [(a2 - a - n, b2 - b - n) for (a, b, n), (a2, b2, _) in zip(blocks, blocks[1:], strict=False)]
    assert all(x >= 0 and y >= 0 and x + y for x, y in gaps)
    assert (row["q_num_insert"], row["q_base_insert"]) == (sum(x > 0 for x, _ in gaps), sum(x for x, _ in gaps))
    assert (row["t_num_insert"], row["t_base_insert"]) == (sum(y > 0 for _, y in gaps), sum(y for _, y in gaps))
    ends = (blocks[0][0], blocks[-1][0] + blocks[-1][2])
    assert (row["q_start"], row["q_end"]) == (ends if row["strand"] == "+" else (len(q) - ends[1], len(q) - ends[0]))
    assert (row["t_start"], row["t_end"], row["q_size"], row["t_size"]) == (blocks[0][1], blocks[-1][1] + blocks[-1][2], len(q), len(t))


def test_500_pairs_equal_full_dynamic_programs(spark):
    pairs = {}
    for i in range(500):
        q = dna(r.randint(80, 140))
        t = dna(r.randint(0, 30)) + changed(q, r.choice([0.0, 0.02, 0.05, 0.08])) + dna(r.randint(0, 30))
        pairs[f"p{i}"] = (q, reversed_(t) if i % 2 else t)
    targets = spark.createDataFrame([(n, q.lower() if len(q) % 2 else q) for n, (q, _) in pairs.items()], "target string, sequence string")
    contigs = spark.createDataFrame([(n, t) for n, (_, t) in pairs.items()], "contig string, sequence string")
    best = {}
    several = 0
    for row in gapped.gapped_hits(targets, contigs, min_seeded=11).where("q_name = t_name").collect():
        q, t = pairs[row["q_name"]]
        consistent(row, q, t)
        several += row["block_count"] > 1
        best[row["q_name"]] = max(best.get(row["q_name"], 0), row["score"])
    assert several > 150
    missed = 0
    for n, (q, t) in pairs.items():
        want = max(full_score(q, t, False), full_score(reversed_(q), t, False))
        if want >= 30 and best.get(n) != want:
            missed += 1  # an alignment without a seed, or beyond the band
            assert best.get(n, 0) < want
    assert missed <= 5


def test_introns_copies_and_frequent_kmers(spark, monkeypatch):
    monkeypatch.setattr(gapped, "FREQUENT", 40)
    a, b, c = dna(100), dna(90), dna(110)
    gene = a + b + c
    contig = dna(50) + a + dna(700) + b + dna(300) + c + dna(60)
    twice = gene + dna(200) + gene
    rows = [("one", contig), ("copy", contig), ("two", twice), ("none", None), ("short", "ACG"), *((f"n{i}", dna(30) + "ACACACACACACACACACACACACAC" * 2 + dna(30)) for i in range(60))]
    targets = spark.createDataFrame([("g", gene), ("rep", "AC" * 40), ("null", None)], "target string, sequence string")
    hits = gapped.gapped_hits(targets, spark.createDataFrame(rows, "contig string, sequence string").withColumn("target", F.lit("clash")))
    got = hits.where("q_name = 'g'").collect()
    exons = [x for x in got if x["t_name"] in ("one", "copy")]
    assert len(exons) == 2 and {x["t_name"] for x in exons} == {"one", "copy"}
    for x in exons:
        consistent(x, gene, contig)
        assert x["matches"] == 300 and x["mismatches"] == 0 and x["block_count"] == 3 and x["t_base_insert"] == 1000
    assert sorted((x["t_start"], x["t_end"]) for x in got if x["t_name"] == "two") == [(0, 300), (500, 800)]
    assert hits.where("q_name = 'rep' and strand = '+' and t_name like 'n%'").select("t_name").distinct().count() == 60
    assert gapped.gapped_hits(targets, spark.createDataFrame([], "contig string, sequence string")).count() == 0
    assert gapped.gapped_hits(targets, spark.createDataFrame(rows, "contig string, sequence string"), min_identity=101.0).count() == 0


@pytest.mark.parametrize("n, m, size", [(500, 500, 0), (40, 900, 40), (900, 40, 40), (0, 30, 0)])
def test_what_lies_between_anchors(n, m, size):
    q, t = letters(dna(n)), letters(dna(m))
    blocks = gapped.filled(q, t)
    assert all(a >= 0 and b >= 0 and a + k <= n and b + k <= m for a, b, k in blocks)
    assert not size or sum(k for *_, k in blocks) == size
