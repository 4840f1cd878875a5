"""Clustering by rare k-mers against all pairs."""

import os
import random
from itertools import combinations

import pytest

from phylospark.operators import similarity
from phylospark.plans import views
from phylospark.plans.q_similarity import _saver

r = random.Random(2)
DATA = "/root/testdata/sf0.001"


def dna(n):
    return "".join(r.choice("ACGT") for _ in range(n))


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def tokens(s, k):
    return {min(s[i : i + k], back(s[i : i + k])) for i in range(len(s) - k + 1)}


def all_pairs(seqs, identity, coverage, k):
    share, sets, out = max(coverage / 100, (identity / 100) ** k), {n: tokens(s, k) for n, s in seqs.items()}, set()
    for a, b in combinations(sorted(seqs), 2):
        least = min(len(sets[a]), len(sets[b]))
        if least and len(sets[a] & sets[b]) >= share * least - 1e-9:
            out.add((a, b))
    return out


def changed(s, rate):
    return "".join(r.choice("ACGT") if r.random() < rate else c for c in s)


@pytest.mark.parametrize("identity, coverage, k", [(75.0, 50.0, 11), (90.0, 20.0, 9), (98.0, 43.0, 15), (99.0, 100.0, 7)])
def test_edges_equal_all_pairs(spark, identity, coverage, k):
    base = [dna(r.randint(40, 300)) for _ in range(8)]
    seqs = {}
    for i in range(90):
        s = r.choice(base)
        kind = r.random()
        s = changed(s, r.choice([0, 0.01, 0.03, 0.1])) if kind < 0.6 else s[r.randint(0, 30) :][: r.randint(20, 120)] if kind < 0.8 else "AC" * r.randint(5, 40) + dna(20)
        seqs[f"s{i:02}"] = back(s) if r.random() < 0.3 else s
    seqs |= {"short": "ACG", "same1": base[0], "same2": base[0]}
    frame = spark.createDataFrame([(n, s, i % 1) for i, (n, s) in enumerate(seqs.items())], "name string, sequence string, g int")
    got = {tuple(sorted((x["name"], x["other"]))) for x in similarity._edges(frame, ["g"], identity, coverage, k, "name", _saver(spark)).collect()}
    assert got == all_pairs(seqs, identity, coverage, k) and len(got) > 20


def check_clusters(rows, seqs, identity, coverage, k):
    """Every sequence is in one cluster, near its centroid or equal to it, and no two centroids are near."""
    near = all_pairs(seqs, identity, coverage, k)
    of = {m: c for c, m in rows}
    assert len(rows) == len(of) == len(seqs)
    linked = lambda a, b: seqs[a].upper() == seqs[b].upper() or (min(a, b), max(a, b)) in near
    assert all(linked(c, m) for m, c in of.items())
    assert not any(linked(a, b) for a, b in combinations(sorted(set(of.values())), 2))
    assert all(len(seqs[c]) >= len(seqs[m]) for m, c in of.items())


def test_clusters_are_maximal(spark):
    base = [dna(200) for _ in range(5)]
    seqs = {f"s{i:02}": changed(r.choice(base), 0.02)[: r.randint(120, 200)] for i in range(60)} | {"x": base[0], "y": base[0].lower(), "t": "AC"}
    frame = spark.createDataFrame(list(seqs.items()), "name string, sequence string")
    rows = [tuple(x) for x in similarity.cluster_sequences(frame, identity=90.0, k=11, save=_saver(spark)).select("centroid", "member").collect()]
    check_clusters(rows, {n: s.upper() for n, s in seqs.items()}, 90.0, 50.0, 11)
    assert similarity.cluster_sequences(frame.limit(0), save=_saver(spark)).count() == 0


def test_a_chain_of_equal_lengths_takes_few_rounds(spark):
    whole, steps = dna(120 + 20 * 200), []
    frame = spark.createDataFrame([(f"b{i:04}", whole[20 * i : 20 * i + 120]) for i in range(200)], "name string, sequence string")

    def save(f):
        steps.append(1)
        return _saver(spark)(f)

    kept = similarity.thin_clustered_baits(frame, save=save).count()
    assert 60 <= kept <= 110 and len(steps) < 40


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_contigs_equal_all_pairs(spark):
    rows = views.contigs(spark, DATA).select("contig", "sequence").where("length >= 15").collect()
    seqs = {x["contig"]: x["sequence"].upper() for x in rows}
    frame = spark.createDataFrame(list(seqs.items()), "name string, sequence string")
    got = [tuple(x) for x in similarity.cluster_sequences(frame, identity=90.0, coverage=50.0, k=15, save=_saver(spark)).select("centroid", "member").collect()]
    check_clusters(got, seqs, 90.0, 50.0, 15)
