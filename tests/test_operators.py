import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phylospark.operators import assembly, grouped, hits, reads, similarity, sites, targets
from phylospark.sources import readers, writers
from phylospark.streaming.ingest import ingest_new


def test_fasta_scan_joins_lines_and_drops_empty_records(spark, tmp_path):
    text = ">a desc one\nACGT\nAC\n>b\nGG\n>c\n>d x\nTT\n\nNN\n>a again\nTT"
    (tmp_path / "x.fasta").write_text(text)
    with gzip.open(tmp_path / "y.fasta.gz", "wt") as f:
        f.write(">z\nAC\nGT\n")
    got = {(r["name"], r["description"]): r["sequence"] for r in readers.read_fasta(spark, [str(tmp_path / "x.fasta"), str(tmp_path / "y.fasta.gz")]).collect()}
    assert got == {("a", "again"): "TT", ("b", ""): "GG", ("d", "x"): "TTNN", ("z", ""): "ACGT"}


def test_fastq_scan(spark, tmp_path):
    (tmp_path / "s_R1.fq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\n!!\n")
    got = readers.read_fastq(spark, str(tmp_path / "s_R1.fq")).orderBy("read_id").collect()
    assert [(r["read_id"], r["sequence"], r["quality"]) for r in got] == [("r1", "ACGT", "IIII"), ("r2", "GG", "!!")]


def test_files_pair_by_name(spark):
    files = spark.createDataFrame([(f"/d/{n}",) for n in ("s_R1.fq", "s_R2.fq", "t_R1.fq", "u__x_R1.fq", "v.fq", "w_R2.fq")], ["path"])
    got = {r["sample"]: r["r2"] for r in readers.pair_files(files).collect()}
    assert got == {"s": "/d/s_R2.fq", "t": None}


def test_gff_cds(spark, tmp_path):
    (tmp_path / "g.gff").write_text("# c\nchr1\tx\tCDS\t3\t8\t.\t+\t.\tID=q;protein_id=p1\nchr1\tx\tgene\t1\t9\t.\t+\t.\tID=g\nchr1\tx\tCDS\t11\t14\t.\t-\t2\tParent=m1\n")
    got = readers.read_gff_cds(spark, str(tmp_path / "g.gff")).orderBy("start").collect()
    assert [(r["cds_id"], r["start"], r["end"], r["shift"]) for r in got] == [("p1", 3, 8, 0), ("m1", 11, 14, 2)]
    genome = spark.createDataFrame([("chr1", "AACCGGTTAACCGGTT")], ["name", "sequence"])
    exons = {r["cds_id"]: r for r in readers.read_cds_exons(readers.read_gff_cds(spark, str(tmp_path / "g.gff")), genome, bait_length=5).collect()}
    assert exons["p1"]["sequence"] == "CCGGTT" and exons["p1"]["long_exons"] == 1 and exons["m1"]["sequence"] == "GG"  # after the two bases of its phase


def test_psl_records(spark):
    line = "10 1 0 0 1 2 0 0 + q1 50 3 14 t1 100 20 31 2 5,6, 3,8, 20,25,"
    got = hits.parse_psl(spark.createDataFrame([(line,), ("too short",), (line.replace("10 1", "x 1", 1),)], ["value"])).collect()
    assert len(got) == 1 and got[0]["block_sizes"] == [5, 6] and got[0]["t_name"] == "t1" and got[0]["wscore"] is None


def test_sam_without_clips(spark, tmp_path):
    row = "{}\t0\tx\t1\t9\t{}\t*\t0\t0\tACGT\tIIII"
    (tmp_path / "a.sam").write_text("@HD\n" + "\n".join([row.format("a", "4M"), row.format("b", "1S3M"), row.format("c", "*")]) + "\n")
    assert [r["name"] for r in readers.unclipped(readers.read_sam(spark, str(tmp_path / "a.sam"))).collect()] == ["a"]


def test_coordinates_and_blocks(spark):
    row = spark.createDataFrame([([11, 5, 3], [20, 40, 300])], "sizes array<int>, starts array<int>")
    merged = hits.merge_blocks(F.col("sizes"), F.col("starts"), F.lit(200))
    assert row.select(hits.format_coordinates(merged).alias("v")).first()["v"] == "21-45,301-303"
    text = spark.createDataFrame([("aaaCCCgggTTTaaa",)], ["s"]).select(hits.extract_blocks(F.col("s"), F.expr("array(named_struct('s', 3, 'e', 6), named_struct('s', 9, 'e', 12))"), 2).alias("v"))
    assert text.first()["v"] == "aaCCCgggTTTaa"


def test_a_rejected_hit_still_rejects_others(spark):
    rows = [(1, "s", 1, 1, 1, 0.9, 0, 100, 0), (2, "s", 1, 2, 2, 0.8, 50, 150, 0), (3, "s", 1, 3, 3, 0.7, 120, 220, 0)]
    h = spark.createDataFrame(rows, "hit_id long, sample string, contig long, locus long, target long, wscore double, t_start long, t_end long, q_start long")
    for width in (7, 60, 100_000):
        assert [r["hit_id"] for r in hits.drop_overlaps(h, 5.0, width).collect()] == [1]


def test_supermatrix_partitions(spark):
    widths = spark.createDataFrame([("a", 100), ("b", 60)], ["locus", "width"])
    got = {r["locus"]: r["sites"] for r in sites.partitions(widths, codon="12").collect()}
    assert got == {"a": "1-100\\3 2-100\\3", "b": "101-160\\3 102-160\\3"}


@pytest.mark.parametrize("rows,expected", [(["A", "A", "A", "A"], "constant"), (["A", "A", "A", "C"], "singleton"), (["A", "A", "C", "C"], "informative"), (["A", "R", "R", "-"], "constant")])
def test_column_classes(spark, rows, expected):
    aln = spark.createDataFrame([("l", f"r{i}", f"T{r}T") for i, r in enumerate(rows)], ["locus", "seq_name", "sequence"])
    got = sites.site_stats(sites.site_counts(aln, ["locus"]), ["locus"]).where("pos = 1").first()
    assert got["class"] == expected


def test_site_identity_equals_the_plain_loop(spark):
    from phylospark.functions import seq

    random.seed(2)
    rows = ["".join(random.choice("ACGTRN-") for _ in range(8)) for _ in range(9)]
    aln = spark.createDataFrame([("l", str(i), f"A{r}A") for i, r in enumerate(rows)], ["locus", "seq_name", "sequence"])
    table = seq.pair_identity("NT")
    for r in sites.site_stats(sites.site_counts(aln, ["locus"]), ["locus"]).where("pos between 1 and 8").collect():
        column = [x[r["pos"] - 1] for x in rows]
        pairs = ["".join(sorted(a + b)) for i, a in enumerate(column) for b in column[i + 1 :]]
        pairs = [p for p in pairs if p != "--"]
        assert r["pairs"] == len(pairs) and abs(r["matches"] - sum(table[p] for p in pairs)) < 1e-9


def test_nx_ignores_row_order(spark):
    c = spark.createDataFrame([("s", n) for n in (5, 1, 4, 4, 2, 9)], ["sample", "length"])
    r = assembly.nx_lx(c, ["sample"], (0.5,)).first()
    assert (r["n50"], r["l50"]) == (5, 2)


def test_reads_sampled_up_to_a_target(spark):
    df = spark.createDataFrame([("s", f"r{i // 2}", i % 2, "A" * 10) for i in range(200)], "sample string, read_id string, mate int, sequence string")
    got = reads.sample_reads(df, bases=500).collect()
    assert len(got) == 50 and len({r["read_id"] for r in got}) == 25


def test_adaptors_are_cut_at_the_first_match(spark):
    r = spark.createDataFrame([("s", "a", "ccccacgtacgtaa", "I" * 14), ("s", "b", "cccccccccccccc", "I" * 14)], "sample string, read_id string, sequence string, quality string")
    ad = spark.createDataFrame([("x", "acgtacgt")], ["name", "sequence"])
    got = {x["read_id"]: x for x in reads.trim_adaptors(r, ad, k=8, distance=1).collect()}
    assert got["a"]["sequence"] == "cccc" and got["a"]["adaptor"] == "x" and got["b"]["sequence"] == "c" * 14


def test_clusters_hold_members_near_their_centroid(spark):
    random.seed(4)
    base = ["".join(random.choice("ACGT") for _ in range(300)) for _ in range(4)]
    rows = [(f"{i}_{j}", b[: 300 - j]) for i, b in enumerate(base) for j in range(3)]
    c = spark.createDataFrame(rows, ["name", "sequence"])
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = {r["member"]: r["centroid"] for r in similarity.cluster_sequences(c, identity=90.0, k=15).collect()}
    assert got == {f"{i}_{j}": f"{i}_0" for i in range(4) for j in range(3)}


def test_a_short_sequence_inside_a_long_one_is_clustered(spark):
    random.seed(6)
    draw = lambda n: "".join(random.choice("ACGT") for _ in range(n))
    big = draw(20_000)
    rows = [("big", big), ("inside", big[9_000:9_200]), ("copy", big[9_000:9_200].lower()), ("other", draw(200)), ("tiny", "ACG")]
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = {r["member"]: r["centroid"] for r in similarity.cluster_sequences(spark.createDataFrame(rows, ["name", "sequence"]), identity=90.0, k=15).collect()}
    assert got == {"big": "big", "inside": "big", "copy": "big", "other": "other", "tiny": "tiny"}


def test_hits_on_the_other_strand_and_in_frames(spark):
    random.seed(7)
    draw = lambda n: "".join(random.choice("ACGT") for _ in range(n))
    target = draw(90)
    back = target[::-1].translate(str.maketrans("ACGT", "TGCA"))
    contigs = spark.createDataFrame([("plus", draw(31) + target + draw(20)), ("minus", draw(40) + back + draw(11))], ["contig", "sequence"])
    targets = spark.createDataFrame([("t", target)], ["target", "sequence"])
    got = {(r["contig"], r["strand"], r["t_start"], r["t_end"]) for r in similarity.seed_hits_on_both_strands(targets, contigs, k=21).collect()}
    assert got == {("plus", "+", 31, 121), ("minus", "-", 40, 130)}
    from phylospark.functions import seq

    proteins = targets.withColumn("sequence", seq.translate(targets["sequence"]))
    got = {(r["contig"], r["frame"], r["t_start"], r["t_end"]) for r in similarity.translated_hits(proteins, contigs, k=7).collect()}
    assert got == {("plus", 2, 31, 121), ("minus", -3, 40, 130)}


def test_windows_of_a_bait(spark):
    got = targets.tile(spark.createDataFrame([("a", "ac-gtac"), ("b", "ac")], ["name", "sequence"]), length=4).collect()
    assert [(r["bait_no"], r["bait"]) for r in got] == [(1, "ACGT"), (2, "CGTA"), (3, "GTAC")]
    assert {r["bait"] for r in targets.dereplicate(targets.tile(spark.createDataFrame([("a", "AACC"), ("b", "GGTT")], ["name", "sequence"]), length=4)).collect()} == {"AACC"}


def test_haplotypes_merge_first_fit():
    assert grouped.merged_haplotypes(["AC--", "--GT", "AG--", "----"]) == ["ACGT", "AG--"]


def test_rare_segments_are_masked(spark):
    random.seed(5)
    common = "".join(random.choice("ACGT") for _ in range(90))
    odd = common[:30] + "".join(random.choice([b for b in "ACGT" if b != c]) for c in common[30:60]) + common[60:]
    aln = spark.createDataFrame([("l", f"r{i}", common) for i in range(12)] + [("l", "odd", odd)], ["locus", "seq_name", "sequence"])
    got = {r["seq_name"]: r for r in grouped.mask_outliers(aln, ["locus"]).collect()}
    assert got["r0"]["masked"] == 0 and 25 <= got["odd"]["masked"] <= 50 and "?" * 20 in got["odd"]["sequence"]


def test_repeats_are_masked(spark):
    b = spark.createDataFrame([("AT" * 30,), ("ACGTTGCAAGCTAGGATCCATGCATTCGAACTGACCTGAATTCGGCATCAGTTCAAGCTGA",)], ["bait"])
    got = [r["bait"] for r in similarity.mask_low_complexity(b).collect()]
    assert any(x.islower() for x in got[0]) and got[1].isupper()


def test_new_samples_are_ingested_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([("a", 1)], "sample string, n int").write.parquet(src)
    run = lambda: ingest_new(spark, src, "sample string, n int", out, state)
    run()
    spark.createDataFrame([("a", 2), ("b", 3)], "sample string, n int").write.mode("append").parquet(src)
    run()
    run()
    assert sorted((r["sample"], r["n"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]


def test_tables_keep_nulls(spark, tmp_path):
    writers.write_table(spark.createDataFrame([("a", None), ("b", 2.5)], "x string, y double"), str(tmp_path / "t"))
    assert sorted((r["x"], r["y"]) for r in readers.read_table(spark, str(tmp_path / "t"), "x string, y double").collect()) == [("a", None), ("b", 2.5)]


def test_phylip_and_nexus_agree_on_rows(spark):
    m = spark.createDataFrame([("a", "ACGT"), ("long", "AC-T")], ["name", "sequence"])
    assert [r["line"] for r in writers.phylip_lines(m).orderBy("ord", "name").collect()] == ["2 4", "a     ACGT", "long  AC-T"]
    assert [r["line"] for r in writers.nexus_lines(m).orderBy("ord", "name").collect()][2] == "DIMENSIONS NTAX=2 NCHAR=4;"


def plain_rare(level, sums, cutoff, k):
    """All two-state paths whose changes take k windows; the most windows agreed with, then the heaviest."""

    def walk(i, state):
        own = (int((level[i] > cutoff) == bool(state)), sums[i] if state else 0.0)
        if i == 0:
            return own[0], own[1], [(0, state)]
        before = [walk(i - 1, state)] + ([walk(i - k, 1 - state)] if i >= k else [])
        top = max(before, key=lambda x: x[:2])
        return top[0] + own[0], top[1] + own[1], [*top[2], (i, state)]

    ends = [walk(len(level) - 1, state) for state in (0, 1)]
    rare = np.zeros(len(level), bool)
    for i, state in ends[int(ends[1][0] > ends[0][0])][2]:
        rare[i] = state
    return rare


def test_rare_windows_equal_all_paths():
    r = np.random.default_rng(3)
    for _ in range(40):
        level = np.where(r.random(12) < 0.4, 5.0, 1.0) + 0.01 * r.random(12)
        sums = r.random(12)
        assert (grouped.rare_windows(level, sums, 3.0, 3) == plain_rare(level, sums, 3.0, 3)).all()
    assert grouped.split_level(np.array([1.0, 9.0, 1.1, 1.2, 8.0])) == 1.2
    assert grouped.top_share(np.arange(10.0), 0.25) == 7.0 and grouped.top_share(np.arange(3.0), 1) == 0
    level, sums = grouped.window_levels(np.array([1.0, 5.0, 2.0, 4.0, 3.0, 9.0]), 5)
    assert level.tolist() == [3.0, 4.0] and sums.tolist() == [15.0, 23.0]
    assert not len(grouped.window_levels(np.ones(3), 5)[0])


def test_an_ambiguity_letter_ends_a_run():
    w, none = np.concatenate([np.ones(240), np.full(34, 9.0), np.ones(240)]), np.zeros(514, bool)
    cut = none.copy()
    cut[257] = True
    whole = grouped.rare_residues(w, [0.0] * 3, 3.0, none)
    assert whole[240:274].all() and whole.sum() <= 54
    only = grouped.PASSES
    try:
        grouped.PASSES = only[:1]  # runs under 30
        assert not grouped.rare_residues(w, [0.0], 3.0, none).any() and grouped.rare_residues(w, [0.0], 3.0, cut)[240:274].all()
    finally:
        grouped.PASSES = only


def test_greedy_paths_by_hand(spark):
    cols = "k int, hit_id long, wscore double, identity double, q_start long, q_end long, region string"
    rows = [(1, 1, 0.9, 90.0, 0, 100, "proximal"), (1, 2, 0.8, 91.0, 90, 200, "distal"), (1, 3, 0.7, 80.0, 210, 300, "distal"), (1, 4, 0.6, 90.5, 5, 95, "middle"), (1, 5, 0.5, 90.0, 0, 300, "full"), (1, 6, 0.4, 89.0, 250, 300, "distal"), (2, 7, 0.1, 70.0, 0, 300, "full")]
    got = {r["hit_id"]: r["path"] for r in grouped.greedy_paths(spark.createDataFrame(rows, cols), ["k"]).collect()}
    assert got == {1: "path0", 2: "path0", 3: "path1", 4: "path2", 5: "full0", 6: "path0", 7: "full0"}


def test_overlap_kinds_and_share(spark):
    rows = spark.createDataFrame([([(0, 10), (20, 30)], [(5, 8), (25, 40)]), ([(0, 10)], [(10, 20)])], "a array<struct<s:int,e:int>>, b array<struct<s:int,e:int>>")
    got = rows.select(hits.overlap_kinds(F.col("a"), F.col("b")).alias("k"), hits.overlap_percent(F.col("a"), F.col("b"), F.lit(30), F.lit(35)).alias("p")).collect()
    assert [r["k"] for r in got] == ["F,N,N,P", "N"] and [round(r["p"], 4) for r in got] == [round(800 / 35, 4), 0]


def test_depth_trim_counts_spans_without_addons(spark):
    rows = [("L", "a", "s1", "-AC-TA--"), ("L", "b", "s2", "--CGT---"), ("L", "c", "x", "AAAAAAAA"), ("M", "d", "s1", "--AC--")]
    aln = spark.createDataFrame(rows, "locus string, seq_name string, sample string, sequence string")
    add = spark.createDataFrame([("x",)], "sample string")
    got = {r["seq_name"]: r["sequence"] for r in sites.trim_by_depth(aln, ["locus"], 0.2, add).collect()}
    assert got == {"a": "AC-TA", "b": "-CGT-", "c": "AAAAA", "d": "--AC--"}  # one of two rows is enough; a lone row isn't cut
    strict = {r["seq_name"]: r["sequence"] for r in sites.trim_by_depth(aln.where("locus = 'L'"), ["locus"], 0.0, add).collect()}
    assert strict == {"a": "C-T", "b": "CGT", "c": "AAA"}


def test_adaptor_rounds_tips_and_poly_a(spark):
    ad = "GATCGGAAGAGCACACGTCTG"
    rows = [("s", "whole", "ACGTTGCAAGGCTTAACCGTTGGCACCTGA" + ad + "TTTT"), ("s", "tip", "ACGTTGCAAGGCTTAACCGTTGGCACCTGA" + ad[:12]), ("s", "clean", "ACGTTGCAAGGCTTAACCGTTGGCACCTGATT"), ("s", "short", "ACGTACC" + ad + "CC")]
    frame = spark.createDataFrame([(*r, "I" * len(r[2])) for r in rows], "sample string, read_id string, sequence string, quality string")
    adaptors = spark.createDataFrame([("ad", ad)], "name string, sequence string")
    got = {r["read_id"]: (r["sequence"], r["adaptor_1"], len(r["quality"])) for r in reads.trim_adaptors_in_rounds(frame, adaptors, rounds=((21, 11, 1), (19, 9, 1))).collect()}
    kept = "ACGTTGCAAGGCTTAACCGTTGGCACCTGA"
    assert got == {"whole": (kept, "ad", 30), "tip": (kept, "ad", 30), "clean": (kept + "TT", None, 32)}
    poly = spark.createDataFrame([("s", "a", "AAAACGTTTTT", "IIIIabcJJJJ"), ("s", "b", "AAACG", "IIIII"), ("s", "c", "TTTTTT", "IIIIII")], frame.schema)
    assert {r["read_id"]: (r["sequence"], r["quality"]) for r in reads.trim_poly_a(poly).collect()} == {"a": ("CG", "ab"), "b": ("AAACG", "IIIII"), "c": ("", "")}


def test_contaminated_reads_go_on_either_strand(spark):
    bait = "ACGGTTCAGGATCCTTAGCA"
    rev = bait[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("s", "ahead", "TT" + bait), ("s", "back", rev + "GG"), ("s", "near", bait[:10] + "C" + bait[11:]), ("s", "none", "T" * 30), ("s", "short", "ACG")]
    got = reads.drop_contaminated(spark.createDataFrame(rows, "sample string, read_id string, sequence string"), spark.createDataFrame([(bait,)], "sequence string"), k=20, distance=1)
    assert {r["read_id"] for r in got.collect()} == {"none", "short"}


def test_near_copies_go_and_distinct_sequences_stay(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("ACGT") for _ in range(600))
    changed = base[:300] + ("A" if base[300] != "A" else "C") + base[301:]
    rev = base[::-1].translate(str.maketrans("ACGT", "TGCA"))
    other = "".join(rng.choice("ACGT") for _ in range(600))
    rows = [("s", "a", base), ("s", "b", changed), ("s", "c", rev), ("s", "d", other), ("t", "e", base)]
    got = similarity.deduplicate_near(spark.createDataFrame(rows, "sample string, name string, sequence string"), ["sample"]).collect()
    assert {(r["sample"], r["copies"]) for r in got} == {("s", 3), ("s", 1), ("t", 1)} and {r["name"] for r in got if r["copies"] == 1} == {"d", "e"}
    baits = spark.createDataFrame([("b1", base[:120]), ("b2", base[20:140]), ("b3", base[100:220]), ("b4", other[:120])], "name string, sequence string")
    assert sorted(r["name"] for r in similarity.thin_clustered_baits(baits).collect()) == ["b1", "b3", "b4"]
