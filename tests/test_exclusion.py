"""Baits against all k-mers of a reference: plain sets, ambiguity letters, and how few k-mers are shuffled."""

import random

import pytest

from phylospark.functions import seq
from phylospark.operators import targets

r = random.Random(6)
TURNED = str.maketrans(seq.BASES, seq.COMPLEMENTS)


def kmers(s, k):
    s = s.upper()
    return {min(x, x[::-1].translate(TURNED)) for x in (s[i : i + k] for i in range(len(s) - k + 1))}


def dna(n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


@pytest.mark.parametrize("k", [1, 4, 15, 16, 31, 40])
def test_keys_tell_kmers_apart_as_texts_do(k):
    texts = ["", "ACG", dna(200), dna(90, "ACGTN"), dna(50, "ACGTRY\u00c4"), "N" * 45, dna(k)]
    row, a, b = targets.canonical_keys(texts, k)
    want = [(i, min(x, x[::-1].translate(TURNED))) for i, t in enumerate(texts) for x in (t[j : j + k] for j in range(len(t) - k + 1))]
    assert row.tolist() == [i for i, _ in want]
    names = {}
    assert all(names.setdefault(key, x) == x for key, (_, x) in zip(zip(a.tolist(), b.tolist(), strict=True), want, strict=True))
    assert len(names) == len({x for _, x in want})


@pytest.mark.parametrize("k, size", [(31, 29), (9, 29), (9, 16)])
def test_exclusion_equals_plain_sets(spark, monkeypatch, k, size):
    monkeypatch.setattr(targets, "FILTER", size)
    ref = [dna(3000), dna(500, "ACGTN"), "ACG", "", None]
    baits = []
    for i in range(300):
        t = dna(r.choice([5, 30, 60, 120]), "ACGTNacgt")
        if r.random() < 0.4:
            at, n = r.randrange(2900), r.choice([k - 1, k, k + 3])
            part = ref[0][at : at + n]
            t = t[:10] + (part if i % 2 else part[::-1].translate(TURNED)) + t[10:]
        baits.append((str(i % 40), i, t))
    baits.append(("x", 1, None))
    held = set().union(*(kmers(x, k) for x in ref if x))
    got = targets.exclude_matches(spark.createDataFrame(baits, "name string, bait_no int, bait string"), spark.createDataFrame([(x,) for x in ref], "sequence string"), k)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((n, i, t) for n, i, t in baits if not t or not kmers(t, k) & held), key=str)


def test_kmers_of_baits_are_not_all_shuffled(spark):
    frame = spark.createDataFrame([("a", i, dna(120)) for i in range(50)], "name string, bait_no int, bait string")
    assert targets.exclude_matches(frame, spark.createDataFrame([(dna(2000),)], "sequence string")).count() == 50
    row, a, b = targets.canonical_keys([dna(2000)], 31)
    size = 18
    held = targets._filter(spark.createDataFrame(list(zip(a.view("int64").tolist(), b.view("int64").tolist(), strict=True)), "a long, b long"), size)

    class Held:
        value = held

    assert targets._keys_of(frame, ["name", "bait_no"], "bait", 31, Held, size).count() < 50 * 90 / 20
