"""Adaptors and contaminants found by pieces, against plain comparisons of every window."""

import random

import pytest

from phylospark.operators import reads

r = random.Random(5)


def dna(n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


def slipped(s, n):
    s = list(s)
    for i in r.sample(range(len(s)), n):
        s[i] = r.choice("ACGTN")
    return "".join(s)


def differ(a, b):
    return sum(x != y or x not in "acgt" for x, y in zip(a, b, strict=True))


def plain_cut(read, adaptors, k, distance):
    s = read.lower()
    for p in range(len(s) - k + 1):
        near = [n for n, a in adaptors for i in range(len(a) - k + 1) if differ(s[p : p + k], a[i : i + k].lower()) <= distance]
        if near:
            return read[:p], min(near)
    return read, None


def plain_tip(read, adaptors, least, k, distance):
    s = read.lower()
    for n in range(min(k - 1, len(s)), least - 1, -1):
        near = [name for name, a in adaptors if len(a) >= n and differ(s[-n:], a[:n].lower()) <= distance]
        if near:
            return read[:-n], min(near)
    return read, None


def frame(spark, rows):
    return spark.createDataFrame([("s", f"r{i}", s, None if s is None else "I" * len(s)) for i, s in enumerate(rows)], "sample string, read_id string, sequence string, quality string")


@pytest.mark.parametrize("k, distance, held", [(21, 2, 1 << 20), (21, 2, 100), (31, 1, 1 << 20), (6, 1, 1 << 20), (9, 0, 1 << 20)])
def test_first_adaptor_equals_every_comparison(spark, monkeypatch, k, distance, held):
    monkeypatch.setattr(reads, "HELD_KMERS", held)
    adaptors = [(f"a{i:02}", dna(r.randint(k - 1, k + 12))) for i in range(12)] + [("n", dna(k) + "N" + dna(k)), ("a99", dna(k - 1))]
    rows = [None, "", "ACG", "N" * 60]
    for _ in range(120):
        _, a = r.choice(adaptors)
        rows.append(dna(r.randint(0, 50)) + (slipped(a, r.choice([0, 1, 2, 3])) if len(a) > 3 else a) + dna(r.randint(0, 20)))
    got = {x["read_id"]: x for x in reads.trim_adaptors(frame(spark, rows), spark.createDataFrame(adaptors, "name string, sequence string"), k, distance).collect()}
    hits = 0
    for i, s in enumerate(rows):
        row = got[f"r{i}"]
        if s is None:
            assert row["sequence"] is None and row["adaptor"] is None
            continue
        assert (row["sequence"], row["adaptor"]) == plain_cut(s, adaptors, k, distance) and len(row["quality"]) == len(row["sequence"])
        hits += row["adaptor"] is not None
    assert hits > 30


def test_tips_equal_every_comparison(spark):
    adaptors = [(f"a{i}", dna(r.randint(8, 30))) for i in range(20)]
    rows = [None, "", "ACG"] + [dna(r.randint(0, 30)) + slipped(a[: r.randint(8, len(a))], r.choice([0, 1, 2])) for _, a in adaptors * 6]
    out = reads.trim_adaptor_tips(frame(spark, rows), spark.createDataFrame(adaptors, "name string, sequence string"))
    for row in out.collect():
        s = rows[int(row["read_id"][1:])]
        assert (row["sequence"], row["adaptor"]) == ((None, None) if s is None else plain_tip(s, adaptors, 11, 21, 2))


def test_289_adaptors_at_the_defaults_without_a_shuffle(spark):
    adaptors = [(f"ad{i:03}", dna(r.choice([21, 33, 34, 58, 64]))) for i in range(289)]
    rows = [dna(r.randint(0, 120)) + slipped(r.choice(adaptors)[1], r.choice([0, 1, 2, 3])) for _ in range(60)] + [dna(151) for _ in range(20)]
    out = reads.trim_adaptors(frame(spark, rows), spark.createDataFrame(adaptors, "name string, sequence string"))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for row in out.collect():
        assert (row["sequence"], row["adaptor"]) == plain_cut(rows[int(row["read_id"][1:])], adaptors, 21, 2)


def test_no_adaptors_and_no_reads(spark):
    none = spark.createDataFrame([], "name string, sequence string")
    assert [x["sequence"] for x in reads.trim_adaptors_in_rounds(frame(spark, ["A" * 40]), none).collect()] == ["A" * 40]
    assert reads.trim_adaptors(frame(spark, ["A"]).limit(0), none).count() == 0
    with pytest.raises(ValueError):
        reads.trim_adaptors(frame(spark, ["A"]), none, k=32)


def test_contaminants_equal_every_comparison(spark):
    bait = dna(60)
    back = bait[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [dna(40) + slipped(r.choice([bait, back])[5:45], r.choice([0, 1, 2, 3])) for _ in range(60)] + [None, "", dna(100)]
    kept = {x["read_id"] for x in reads.drop_contaminated(frame(spark, rows), spark.createDataFrame([(bait,), ("ACGT",)], "sequence string")).collect()}
    both = [("x", bait), ("y", back)]
    assert kept == {f"r{i}" for i, s in enumerate(rows) if s is None or plain_cut(s, both, 31, 1)[1] is None}


def plain_insert(a, b, penalty=3, least=14):
    """Every offset, every pair of facing bases."""
    pair, best, found = {"A": "T", "T": "A", "C": "G", "G": "C"}, least, None
    for n in range(1, len(a) + len(b)):
        faced = [(a[i], b[n - 1 - i]) for i in range(len(a)) if 0 <= n - 1 - i < len(b)]
        same = sum(pair.get(x) == y for x, y in faced)
        votes = same - penalty * (len(faced) - same)
        if faced and votes >= best:
            best, found = votes, n
    return found


def test_inserts_of_mates_equal_every_offset(spark):
    rows, reads_of = [], {}
    for f in range(120):
        n = r.choice([10, 14, 30, 60, 90, 140, 200])
        whole = dna(n)
        back = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
        a, b = (x[:80] + dna(max(0, 80 - len(x))) for x in (whole, back))
        a, b = slipped(a, r.choice([0, 0, 2, 8]))[: r.choice([80, 55])], slipped(b, r.choice([0, 0, 2]))
        if f % 10 == 0:
            b = "AC" * 30
        reads_of[f] = (a, b)
        rows += [("s", f, 1, a, "I" * len(a)), ("s", f, 2, b, "J" * len(b))]
    rows += [("s", 900, 1, "ACGT" * 10, "I" * 40), ("s", 901, 1, None, None), ("s", 901, 2, "ACGT" * 9, "I" * 36), ("t", 0, 2, "A" * 50, "I" * 50), ("s", 902, 1, "", ""), ("s", 902, 2, "", "")]
    frame = spark.createDataFrame(rows, "sample string, fragment long, mate int, sequence string, quality string")
    out = reads.trim_mate_overlap(frame).collect()
    assert len(out) == len(rows)
    cut = 0
    for x in out:
        if x["sample"] == "s" and x["fragment"] < 900:
            pair = reads_of[x["fragment"]]
            own, other = pair if x["mate"] == 1 else pair[::-1]
            n = plain_insert(own, other)
            assert x["insert"] == n and x["sequence"] == own[:n] and len(x["quality"]) == len(x["sequence"])
            cut += n is not None and n < len(own)
        else:
            assert x["insert"] is None
    assert cut > 40
