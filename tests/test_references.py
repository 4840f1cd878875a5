"""Target sets and reference candidates on hand-made sequences."""

import random
from statistics import median

from phylospark.operators import hits, references
from phylospark.plans.q_similarity import _saver

r = random.Random(6)


def dna(n):
    return "".join(r.choice("ACGT") for _ in range(n))


def changed(s, n):
    s = list(s)
    for i in r.sample(range(len(s)), n):
        s[i] = {"A": "C", "C": "G", "G": "T", "T": "A"}[s[i]]
    return "".join(s)


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_target_set_by_hand(spark):
    a, b, c, d = dna(600), dna(500), dna(400), dna(300)
    targets = [
        ("t1-A", "A", a), ("t2-A", "A", changed(a, 2)), ("t3-A", "A", a[:300]),  # one cluster
        ("t4-A", "A", dna(200)),  # its own cluster, too short for its locus
        ("t1-B", "B", b), ("t1-C", "C", b[:480]),  # B includes C
        ("t2-C", "C", c), ("t1-D", "D", d), ("t1-E", "E", dna(100)),
    ]
    baits = [("A", 10), ("B", 9), ("C", 8), ("D", 2), ("X", 4)]
    frame = spark.createDataFrame(targets, "name string, locus string, sequence string")
    loci, kept = references.target_set(frame, spark.createDataFrame(baits, "locus string, baits long"), save=_saver(spark))
    got = {x["locus"]: (x["targets"], x["max_length"], x["exp_tiling"], x["includes"], x["included_in"], x["removed"]) for x in loci.collect()}
    assert got == {
        "A": (1, 600, 2.0, "", "", ""), "B": (1, 500, 2.16, "C", "", ""), "C": (1, 480, 2.0, "", "B", ""),
        "D": (0, 300, 0.8, "", "", "tiling=0.80"), "X": (0, None, 0.0, "", "", "tiling=0.00"),
    }
    rows = {x["locus"]: x for x in kept.collect()}
    assert {k: (x["name"], x["cluster_size"], x["includes"]) for k, x in rows.items() if k != "A"} == {"B": ("t1-B", 2, "C"), "C": ("t2-C", 1, "")}
    assert rows["A"]["name"] in ("t1-A", "t2-A") and rows["A"]["cluster_size"] == 3 and len(rows["A"]["sequence"]) == 600
    loci, kept = references.target_set(frame, spark.createDataFrame(baits, "locus string, baits long"), min_tiling=2.1, remove_ambiguous=True, save=_saver(spark))
    assert {x["locus"]: x["removed"] for x in loci.collect()} == {"A": "tiling=2.00", "B": "ambiguous", "C": "ambiguous,tiling=2.00", "D": "tiling=0.80", "X": "tiling=0.00"}
    assert kept.count() == 0


def test_reference_candidates_by_hand(spark):
    a, b = dna(900), dna(700)
    near = changed(a, 60)  # 93 %: in the first clusters of 90, apart at 91 and more only where further away
    far = changed(a, 85)
    rows = [("a1", "s1", a), ("a2", "s2", changed(a, 1)), ("a3", "s3", back(changed(a, 2))), ("a4", "s4", far), ("a5", "s5", back(far[:880])), ("short", "s6", a[:200])]
    rows += [(f"b{i}", f"s{i}", changed(b, 1)) for i in range(1, 4)]  # three samples only
    rows += [(f"c{i}", "s1", dna(600)) for i in range(3)] + [("null", "s1", None), ("near", "s7", near)]
    frame = spark.createDataFrame(rows, "name string, sample string, sequence string")
    out = {x["name"]: x for x in references.reference_candidates(frame, identity=88.0, save=_saver(spark)).collect()}
    assert {x["cluster"] for x in out.values()} == {"cluster1"} and not set(out) & {"short", "b1", "b2", "b3"}
    ranks = sorted(out.values(), key=lambda x: x["rank"])
    assert [x["rank"] for x in ranks] == list(range(1, len(out) + 1)) and ranks[0]["samples"] >= ranks[-1]["samples"]
    first = ranks[0]["sequence"]
    for x in ranks:
        same = {first[i : i + 15] for i in range(len(first) - 14)}
        votes = lambda s: sum(s[i : i + 15] in same for i in range(len(s) - 14))
        assert votes(x["sequence"]) >= votes(back(x["sequence"]))
    assert sum(x["seqs"] for x in ranks) <= 7 and all(x["copies"] == median([x["copies"]]) for x in ranks)
    single = references.reference_candidates(frame, identity=88.0, single=True, save=_saver(spark)).collect()
    assert [x["name"] for x in single] == [ranks[0]["name"]] and single[0]["strand"] == "+"
    assert references.reference_candidates(frame.limit(0), save=_saver(spark)).count() == 0


def plain_number(t, loci, largest, first, budget, chromosome):
    if first and t * (t - 1) < budget:
        return 3 if largest >= chromosome else 7
    if not first and t * (t - 1) <= budget:
        return None
    n = 10 if largest >= chromosome else 100
    for k in range(n, 1, -1):
        if loci * k * (loci - 1) * k <= budget:
            break
        n -= 1
    return max(1, n)


def test_numbers_of_targets_equal_a_plain_loop(spark):
    for loci, each, largest in ((3, 4, 100), (30, 20, 100), (30, 20, 20_000_000), (1, 50, 5)):
        rows = [("s", f"L{i}", f"t{i}_{j}", largest - (j > 0), float(j % 5)) for i in range(loci) for j in range(each)]
        frame = spark.createDataFrame(rows, "sample string, locus string, target string, t_size long, wscore double")
        for first in (True, False):
            for budget in (10, 5000, 100_000, 400_000_000):
                (row,) = hits.target_numbers(frame, ["sample"], first, budget).collect()
                want = plain_number(loci * each, loci, largest, first, budget, 10_000_000)
                assert row["best_n"] == want
                if budget == 5000:
                    kept = hits.budgeted_targets(frame, ["sample"], first, budget).count()
                    assert kept == loci * min(each, want or each)
