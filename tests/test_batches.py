"""Steps that pass in Arrow batches against plain loops: merged haplotypes, masked windows, counts of sites, kept columns."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phylospark.operators import grouped, similarity, sites
from phylospark.plans import catalog, registry, views  # noqa: F401

r = random.Random(11)
DATA = "/root/testdata/sf0.001"


def draw(n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


def plain_haplotypes(rows):
    found = []
    for s in rows:
        if set(s) <= {"-"}:
            continue
        for i, h in enumerate(found):
            if all(a == b or "-" in (a, b) for a, b in zip(h, s)):
                found[i] = "".join(b if a == "-" else a for a, b in zip(h, s))
                break
        else:
            found.append(s)
    return found


def test_copies_pass_as_a_stream(spark):
    base = [draw(24) for _ in range(300)]
    rows = [("l1", f"s{i % 2}", f"r{i:04}", "".join(c if r.random() < 0.4 else "-" for c in r.choice(base))) for i in range(900)] + [("l2", "s0", "x", "-" * 24), ("l2", None, "y", draw(24))]
    frame = spark.createDataFrame(rows, "locus string, sample string, seq_name string, sequence string")
    out = grouped.minimum_copies(frame, ["locus"])
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()  # no call a group
    want = {}
    for key in {x[:2] for x in rows}:
        first = {}
        for x in sorted(x for x in rows if x[:2] == key):
            first.setdefault(x[3], x[2])
        if n := len(plain_haplotypes([s for s, _ in sorted(first.items(), key=lambda p: p[1])])):
            want[key] = n
    assert {(x["locus"], x["sample"]): x["copies"] for x in out.collect()} == want and max(want.values()) > 20
    seqs = [x[3] for x in rows[:400]]
    assert grouped.merged_haplotypes(seqs) == plain_haplotypes(seqs)


def plain_mask(bait, window, step, limit):
    out = bait
    for s in range(0, max(1, len(bait) - window + 1), step):
        w = bait[s : s + window]
        pairs = sum(n * (n - 1) // 2 for n in Counter(w[i : i + 3] for i in range(len(w) - 2)).values())
        if len(w) > 3 and pairs / (len(w) - 3) > limit:
            out = out[:s] + out[s : s + window].lower() + out[s + window :]
    return out


def test_masked_windows_equal_a_plain_loop(spark):
    baits = [draw(n, letters) for n in (0, 1, 2, 3, 4, 39, 40, 41, 60, 120) for letters in ("A", "AC", "ACGT", "ACGTRYMKSWN", "AÄ€C") for _ in range(4)] + [draw(50) + "AT" * 25 + draw(20)]
    frame = spark.createDataFrame([(i, b) for i, b in enumerate([*baits, None])], "i int, bait string")
    got = [x["bait"] for x in similarity.mask_low_complexity(frame, limit=1.2).orderBy("i").collect()]
    assert got == [plain_mask(b, 40, 20, 1.2) for b in baits] + [None]
    assert "ArrowEvalPython" in similarity.mask_low_complexity(frame)._jdf.queryExecution().toString()  # whole batches, not letters of a row


def test_windows_take_every_letter_once(spark):
    text = draw(1000)
    frame = spark.createDataFrame([(s,) for s in (text, text[:5], text[:14], "a\nb", "")], "s string")
    got = frame.select(views.windows(F.col("s"), 7)).collect()
    assert [x[0] for x in got] == [[s[i : i + 7] for i in range(0, len(s), 7)] for s in (text, text[:5], text[:14], "a\nb", "")]


def test_sites_are_counted_by_locus_in_batches(spark):
    rows = [(f"l{i % 7}" if i % 11 else None, f"r{i}", draw(r.choice((0, 9, 14)), "ACGT-N?é")) for i in range(500)]
    frame = spark.createDataFrame(rows, "locus string, seq_name string, sequence string")
    want, patterns = Counter(), {}
    for locus, name, s in rows:
        s = s.upper()
        inner = s.strip("-")
        ends = (len(s) - len(s.lstrip("-")), len(s) - len(s.rstrip("-"))) if inner else (len(s), 0)
        marked = "#" * ends[0] + inner + "#" * ends[1]
        want.update((locus, i, c) for i, c in enumerate(marked))
        for i, c in enumerate(marked):
            patterns.setdefault(locus, {}).setdefault(i, []).append((name, "-" if c in "?.~ONX#" else c))
    out = sites.site_counts(frame, ["locus"])
    assert {(x["locus"], x["pos"], x["residue"]): x["n"] for x in out.where("residue <> ''").collect()} == dict(want)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()  # letters make no rows
    got = {x["locus"]: x["patterns"] for x in sites.column_patterns(frame, ["locus"], "seq_name").collect()}
    assert got == {k: len({tuple(c) for c in v.values()}) for k, v in patterns.items()}


def test_kept_columns_by_runs_and_by_letters(spark):
    texts = [("l", f"r{i}", draw(200)) for i in range(5)] + [("l", "short", draw(30)), ("m", "x", draw(200))]
    kept = {"l": [3, 4, 5, 40, 41, 199, 250], "m": list(range(0, 200, 2))}
    frame = spark.createDataFrame(texts, "locus string, seq_name string, sequence string")
    of = spark.createDataFrame([(k, r.sample(v, len(v))) for k, v in kept.items()], "locus string, kept array<int>")
    got = {x["seq_name"]: x["sequence"] for x in sites.keep_columns(frame, of, ["locus"]).collect()}
    assert got == {n: "".join(s[p] for p in kept[k] if p < len(s)) for k, n, s in texts}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["j13_length_grid", "q09_read_assignment"])
def test_unread_qualities_are_not_made(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "ascii(" not in plan and "regexp_extract_all" in plan
