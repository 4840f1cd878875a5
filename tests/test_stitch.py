"""Greedy paths against every comparison, and stitched sequences against a plain version."""

import random
import resource
import time

import pytest

from phylospark.functions import seq
from phylospark.operators import grouped, stitch

r = random.Random(4)


def plain_paths(hits):
    """(hit_id, start, end, identity, score): the first path whose members all fit."""
    paths, out = [], {}
    for i, s, e, p, _ in sorted(hits, key=lambda h: (-h[4], h[0])):
        for n, path in enumerate(paths):
            if all(abs(p - q) <= 3.33 and ((v := min(e, b) - max(s, a)) < 1 or (v <= 99 and v < 0.9 * min(e - s, b - a))) for a, b, q in path):
                break
        else:
            n, path = len(paths), []
            paths.append(path)
        path.append((s, e, p))
        out[i] = f"path{n}"
    return out


def made_up(n, size, longest):
    out = []
    for i in range(n):
        s = r.randint(0, size - 20)
        out.append((i, s, min(size, s + r.randint(1, longest)), r.choice([80.0, 82.5, 83.33, 90.0, 95.0]) + r.random(), round(r.random(), 1)))
    return out


@pytest.mark.parametrize("n, size, longest", [(300, 800, 300), (300, 5000, 2000), (400, 300, 30), (200, 1000, 120)])
def test_paths_equal_every_comparison(spark, n, size, longest):
    groups = {k: made_up(n, size, longest) for k in ("a", "b")}
    rows = [(k, *h, "middle") for k, hits in groups.items() for h in hits]
    frame = spark.createDataFrame(rows, "k string, hit_id long, q_start long, q_end long, identity double, wscore double, region string")
    got = {(x["k"], x["hit_id"]): x["path"] for x in grouped.greedy_paths(frame.repartition(5), ["k"]).collect()}
    assert got == {(k, i): p for k, hits in groups.items() for i, p in plain_paths(hits).items()}


@pytest.mark.parametrize("size, longest", [(300, 40), (900, 500), (5000, 2000)])
def test_paths_by_sets_of_bits_equal_every_comparison(monkeypatch, size, longest):
    monkeypatch.setattr(grouped, "FEW", 0)  # sets of bits are used from the first path on
    hits = []
    for i in range(400):
        s = r.randint(0, size) + r.choice([0, 0.5])
        hits.append((i, s, s + r.choice([0, 1, 10 * r.randint(1, 12), r.randint(1, longest)]), r.choice([60.0, 83.33, 99.9, 120.0]) + r.choice([0, 3.33, r.random()]), round(r.random(), 1)))
    paths = grouped.OpenPaths(99)
    got = {i: f"path{paths.put(s, e, p)}" for i, s, e, p, _ in sorted(hits, key=lambda h: (-h[4], h[0]))}
    assert got == plain_paths(hits)


def test_few_paths_are_held_against_a_hit_one_by_one(monkeypatch):
    tried, fits = [], grouped.OpenPaths._fits
    monkeypatch.setattr(grouped.OpenPaths, "_fits", lambda self, *x: tried.append(1) or fits(self, *x))
    paths = grouped.OpenPaths(99)
    for i in range(4000):
        s, n = (i * 7919) % 400, 10 * (1 + (i * 31) % 50)
        paths.put(s, s + n, 70 + (i * 37 % 1000) / 100)
    assert len(tried) < 40 * 4000


def test_very_many_hits_of_one_group_pass_in_bounded_memory():
    paths, before, began = grouped.OpenPaths(99), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    for i in range(100_000):
        s = (i * 7919) % 20_000
        paths.put(s, s + 150 + i % 700, 70 + (i * 31 % 3000) / 100)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000 and time.time() - began < 300
    assert sum(map(len, paths.starts)) == 100_000


def share(a, b):
    letters = seq.letters("NT")
    x, y = set(letters.get(a.upper(), "")), set(letters.get(b.upper(), ""))
    return 0.0 if "-" in (a, b) or not x or not y else len(x & y) / (len(x) * len(y))


def plain_overlap(a, b):
    n = min(len(a), len(b))
    if n > 21:
        for k in range(n, 20, -1):
            if sum(share(x, y) for x, y in zip(a[-k:], b[:k], strict=True)) >= 0.9667 * k - 1e-9:
                return k
    return 0


def dna(n, letters="ACGT"):
    return "".join(r.choice(letters) for _ in range(n))


def test_overlaps_by_ambiguity_letters(spark):
    rows = [("", ""), ("ACG", None), ("A" * 21, "A" * 21), ("A" * 22, "A" * 22)]
    for _ in range(150):
        common = dna(r.choice([15, 21, 22, 40, 90, 600]))
        other = "".join(r.choice("RYSWKMN") if r.random() < 0.01 else r.choice("acgt") if r.random() < 0.02 else c for c in common)
        rows.append((dna(r.randint(0, 30)) + common, other + dna(r.randint(0, 30))))
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string")
    got = {x["i"]: x["n"] for x in frame.select("i", stitch.overlap_length(frame["a"], frame["b"]).alias("n")).collect()}
    assert got == {i: plain_overlap(a or "", b or "") for i, (a, b) in enumerate(rows)} and sum(v > 400 for v in got.values()) > 3


def back(s):
    return s[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca"))


def plain_stitch(parts, contigs, flank):
    """The parts' genes and flanked sequences joined one after the other."""
    def cut(p):
        s, blocks = contigs[p["contig"]], p["blocks"]
        gene = "".join(s[a:b].upper() for a, b in blocks)
        inner = "".join(s[a:b].upper() + (s[b : blocks[i + 1][0]].lower() if i + 1 < len(blocks) else "") for i, (a, b) in enumerate(blocks))
        whole = s[max(0, blocks[0][0] - flank) : blocks[0][0]].lower() + inner + s[blocks[-1][1] : blocks[-1][1] + flank].lower()
        return (gene, whole) if p["strand"] == "+" else (back(gene), back(whole))

    gene, whole = cut(parts[0])
    spans = [[p["q_start"], p["q_end"]] for p in parts]
    for i in range(len(parts) - 1):
        a, b = parts[i], parts[i + 1]
        g, w = cut(b)
        over = a["q_end"] - b["q_start"]
        if over > 0 and a["identity"] >= b["identity"]:
            gene, whole = gene + g[over:], whole + w[over:]
            spans[i + 1][0] += over
        elif over > 0:
            gene, whole = gene[:-over] + g, whole[:-over] + w
            spans[i][1] -= over
        else:
            gene += "n" * -over + g
            k = len(whole)
            while k and not whole[k - 1].isupper():
                k -= 1
            trail = whole[k:] if k else ""
            lead = w[: max((j for j, c in enumerate(w) if c.isupper()), default=0)]
            n = plain_overlap(trail, lead)
            if n:
                whole = whole + w[n:] if a["depth"] >= b["depth"] else whole[:-n] + w
            else:
                rest = -over - len(trail) - len(lead)
                whole += ("n" * rest if rest > 0 else "n" * 10) + w
    return gene, whole, ";".join(f"{s + 1}-{e}" for s, e in spans)


def test_sequences_equal_a_plain_version(spark):
    contigs, hits, paths, want = {}, [], [], {}
    for g in range(60):
        at, parts = 0, []
        shared = dna(40)
        for n in range(r.randint(1, 4)):
            size = r.randint(60, 120)
            start = max(0, at + r.choice([-40, -5, 0, 3, 50, 200]))
            cut = r.randint(20, size - 20)
            intron = r.choice([0, 30])
            lead, tail = dna(r.randint(0, 30)) + (shared if r.random() < 0.5 else ""), (shared if r.random() < 0.5 else "") + dna(r.randint(0, 30) if r.random() < 0.5 else 0)
            body = dna(cut) + dna(intron) + dna(size - cut)
            name, strand = f"c{g}_{n}", r.choice("+-")
            contigs[name] = s = (lead + body + tail) if strand == "+" else back(lead + body + tail)
            blocks = [(len(lead), len(lead) + cut), (len(lead) + cut + intron, len(lead) + size + intron)]
            if strand == "-":
                blocks = [(len(s) - e, len(s) - b) for b, e in blocks[::-1]]
            parts.append({"contig": name, "strand": strand, "blocks": blocks, "q_start": start, "q_end": start + size, "identity": 90 + r.random() * 3, "depth": r.choice([1.0, 2.0, 2.0])})
            hits.append((g, 10 * g + n, start, start + size, 1000, size - 5, 5, parts[-1]["identity"], size / 10, strand, name, parts[-1]["depth"], blocks))
            paths.append((g, 10 * g + n, "path0"))
            at = start + size
        parts.sort(key=lambda p: (p["q_start"], p["q_end"]))
        want[g] = (plain_stitch(parts, contigs, 25), parts)
    schema = "k int, hit_id long, q_start long, q_end long, q_size long, matches long, mismatches long, identity double, coverage double, strand string, contig string, depth double, blocks array<struct<s:long,e:long>>"
    out = stitch.stitch_paths(spark.createDataFrame(hits, schema), spark.createDataFrame(paths, "k int, hit_id long, path string"), spark.createDataFrame(list(contigs.items()), "contig string, sequence string"), ["k"], flank=25)
    rows = out.collect()
    assert len(rows) == len(want)
    for x in rows:
        (gene, whole, spans), parts = want[x["k"]]
        assert (x["seq_gene"], x["seq_flanked"], x["ref_coords"]) == (gene, whole, spans)
        assert x["contigs"] == len(parts) and x["gapped"] == ("n" in gene)
        if len(parts) > 1:
            ends = [e for _, e in (map(int, s.split("-")) for s in spans.split(";"))]
            matched = ends[-1] - int(spans.split("-")[0]) + 1 - gene.count("n")
            assert x["match_len"] == matched and x["coverage"] == pytest.approx(matched / 10, abs=1e-4)
            assert x["identity"] == pytest.approx(sum(p["identity"] for p in parts) / len(parts), abs=1e-4)
