from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import sites, targets


def value(spark, expression, **columns):
    row = spark.createDataFrame([tuple(columns.values())], list(columns)) if columns else spark.range(1)
    return row.select(expression.alias("v")).first()["v"]


def test_reverse_complement_is_its_own_inverse(spark):
    texts = ["ACGTN", "acgtRYSWKMBDHV-", "", "GATTACA?"]
    rows = spark.createDataFrame([(t,) for t in texts], ["s"]).select("s", seq.reverse_complement(seq.reverse_complement(F.col("s"))).alias("r")).collect()
    assert all(r["s"] == r["r"] for r in rows)
    assert value(spark, seq.reverse_complement(F.col("s")), s="AACGT") == "ACGTT"


def test_pair_identity_follows_the_letter_sets():
    table = seq.pair_identity("NT")
    assert (table["AA"], table["AR"], table["NN"], table["-A"], table["--"]) == (1.0, 0.5, 0.25, 0.0, 0.0)


def test_longest_homopolymer_leaves_out_the_last_run(spark):
    assert value(spark, seq.longest_homopolymer(F.col("s")), s="AACCCGTTTTT") == 3
    assert value(spark, seq.longest_homopolymer(F.col("s")), s="TTTTT") == 1


def brute_translate(s, frame):
    plain = {"".join(c): r for c, r in zip(__import__("itertools").product("TCAG", repeat=3), seq.GENETIC_CODES[1][0], strict=True)}
    s = s.upper().replace("-", "")
    if frame < 0:
        s = s[::-1].translate(str.maketrans("ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"))
    out = ""
    for i in range(abs(frame) - 1, len(s) - 2, 3):
        codon = s[i : i + 3]
        if codon.count("N") > 1 or any(c not in seq.NT_LETTERS for c in codon):
            out += "X"
            continue
        got = {plain[a + b + c] for a in seq.NT_LETTERS[codon[0]] for b in seq.NT_LETTERS[codon[1]] for c in seq.NT_LETTERS[codon[2]]}
        out += got.pop() if len(got) == 1 else {"DN": "N", "EQ": "Q", "IL": "L"}.get("".join(sorted(got)), "X")
    return out


def test_translation_of_ambiguous_codons(spark):
    texts = ["ATGGCNTAA", "RAYCAYACTGG", "NNATGY", "AT", "", "ACGTRYSWKMBDHVNACGTTTTYYR", "a-tgc--at"]
    rows = spark.createDataFrame([(t,) for t in texts], ["s"])
    got = rows.select("s", *[seq.translate(F.col("s"), frame=f).alias(f"f{i}") for i, f in enumerate((1, 2, 3, -1, -2, -3))]).collect()
    for r in got:
        for i, f in enumerate((1, 2, 3, -1, -2, -3)):
            assert r[f"f{i}"] == brute_translate(r["s"], f), (r["s"], f)


def test_frame_with_fewest_stops_wins(spark):
    best = value(spark, seq.best_frame(F.col("s")), s="TAATGGCTTAA")
    assert best["frame"] == 2 and best["stops"] == 0
    assert value(spark, seq.mask_premature_stops(F.col("s")), s="M*A-A*") == "MXAA*"


def test_shred_gives_near_equal_pieces(spark):
    got = targets.shred(spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "ACG")], ["name", "sequence"]), 4).orderBy("name").collect()
    assert [(r["name"], len(r["sequence"])) for r in got] == [("a_1_4", 4), ("a_5_7", 3), ("a_8_10", 3), ("b", 3)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("ACGTRN-", min_size=6, max_size=6), st.text("ACGTRN-", min_size=6, max_size=6)), min_size=1, max_size=4))
def test_pairwise_identity_equals_the_plain_loop(spark, pairs):
    table = seq.pair_identity("NT")
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], ["i", "a", "b"])
    got = rows.select("i", sites.pairwise_identity(F.col("a"), F.col("b")).alias("v"), sites.pairwise_identity(F.col("a"), F.col("b"), skip_gaps=True).alias("w")).collect()
    for r in got:
        a, b = pairs[r["i"]]
        lead = lambda s: len(s) - len(s.lstrip("-"))
        span = range(max(lead(a), lead(b)), min(len(a.rstrip("-")), len(b.rstrip("-"))))
        for skip, name in ((False, "v"), (True, "w")):
            seen = [table["".join(sorted(a[p] + b[p]))] for p in span if a[p] + b[p] != "--" and not (skip and "-" in a[p] + b[p])]
            assert abs(r[name] - (100 * sum(seen) / len(seen) if seen else 0)) < 1e-9


def test_ambiguities_resolve_to_their_bases(spark):
    got = value(spark, seq.resolve_ambiguities(F.col("s"), F.lit("x")), s="ACGTRYSWKMBDHVNn-")
    assert len(got) == 17 and all(b in seq.NT_LETTERS[a] for a, b in zip("ACGTRYSWKMBDHVN", got, strict=False)) and got[15].islower() and got[16] == "-"


def test_codons_follow_the_protein(spark):
    assert value(spark, sites.codon_align(F.col("p"), F.col("n")), p="M-A", n="ATGGCC") == "ATG---GCC"
