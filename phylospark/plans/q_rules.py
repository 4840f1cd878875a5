"""Queries over further rules: genetic codes, kinds of overlaps, trimming rounds, reports, files and exons."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import assembly, hits, reads, references, similarity, sites, targets
from phylospark.sources import files, readers

from . import views
from .q_reads import _ADAPTORS, _FLAT, _Q, _adaptors
from .q_similarity import _saver, shared_folder
from .q_sites import _BARE, _CODON, _GCW, _LET
from .q_targets import _COPIES
from .registry import query
from .views import ALIGNMENTS, CLUSTERS, CONTIGS, HITS, READS

_CODES = (4, 22, 27)


def _plain_aa(code: int) -> str:
    aa, marks = seq.GENETIC_CODES[code]
    last = "".join("*" if m == "*" else a for a, m in zip(aa, marks, strict=True))
    at = "(strpos('tcag', c[1]) - 1) * 16 + (strpos('tcag', c[2]) - 1) * 4 + strpos('tcag', c[3])"
    pick = lambda t: f"list_transform({{0}}, lambda c: substr('{t}', cast({at} as bigint), 1))"
    return f"array_to_string({pick(aa).format('list_slice(cd, 1, len(cd) - 1)')}, '') || array_to_string({pick(last).format('list_slice(cd, len(cd), len(cd))')}, '')"


@query("c02_genetic_codes", f"with {CONTIGS}, cs as (select contig, regexp_extract_all(sequence, '...') as cd from contigs) select contig, " + ", ".join(f"case when len(cd) = 0 then '' else {_plain_aa(c)} end as code_{c}" for c in _CODES) + " from cs")
def genetic_codes(spark, sf_dir):
    return views.contigs(spark, sf_dir).select("contig", *[seq.translate(F.col("sequence"), c).alias(f"code_{c}") for c in _CODES])


_TWO = f"{HITS}, bl as (select *, t_start + (t_end - t_start) // 3 as m1, t_end - (t_end - t_start) // 4 as m2 from hits), pr as (select a.hit_id, b.hit_id as other, a.t_start as a1, a.m1 as a2, a.m2 as a3, a.t_end as a4, b.t_start as b1, b.m1 as b2, b.m2 as b3, b.t_end as b4 from bl a join bl b on a.sample = b.sample and a.contig = b.contig and a.locus = b.locus and a.hit_id < b.hit_id)"


def _kind(a: str, b: str, c: str, d: str) -> str:
    return f"case when {a} >= {d} or {c} >= {b} then 'N' when ({c} <= {a} and {d} >= {b}) or ({a} <= {c} and {b} >= {d}) then 'F' else 'P' end"


def _share(a: str, b: str, c: str, d: str) -> str:
    return f"greatest(0, least({b}, {d}) - greatest({a}, {c}))"


_BLOCKS = [(*x, *y) for x in (("a1", "a2"), ("a3", "a4")) for y in (("b1", "b2"), ("b3", "b4"))]


@query("c24_overlap_kinds", f"with {_TWO} select hit_id, other, case when a4 <= b1 or b4 <= a1 then 'N' else " + " || ',' || ".join(_kind(*x) for x in _BLOCKS) + " end as kinds, round(100.0 * (" + " + ".join(_share(*x) for x in _BLOCKS) + ") / greatest(a4 - a1, b4 - b1), 4) as pct from pr")
def overlap_kinds(spark, sf_dir):
    third, quarter = F.floor((F.col("t_end") - F.col("t_start")) / 3), F.floor((F.col("t_end") - F.col("t_start")) / 4)
    block = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
    own = views.hits(spark, sf_dir).select("sample", "contig", "locus", "hit_id", (F.col("t_end") - F.col("t_start")).alias("n"), F.array(block(F.col("t_start"), F.col("t_start") + third), block(F.col("t_end") - quarter, F.col("t_end"))).alias("blocks"))
    other = own.select("sample", "contig", "locus", F.col("hit_id").alias("other"), F.col("n").alias("n2"), F.col("blocks").alias("b2"))
    met = own.join(other, ["sample", "contig", "locus"]).where("hit_id < other")
    return met.select("hit_id", "other", hits.overlap_kinds(F.col("blocks"), F.col("b2")).alias("kinds"), F.round(hits.overlap_percent(F.col("blocks"), F.col("b2"), F.col("n"), F.col("n2")), 4).alias("pct"))


@query("c27_reference_fragmentation", f"""with {HITS}, b as (select sample, locus, contig, sum(t_end - t_start) as len, max(q_size) as size from hits group by 1, 2, 3), r as (select *, sum(len) over w as upto, row_number() over w as n, sum(len) over (partition by sample, locus) as total, max(size) over (partition by sample, locus) as ref from b window w as (partition by sample, locus order by len desc, contig rows unbounded preceding))
    select sample, locus, count(*) as num_contigs, """ + ", ".join(f"max(len) filter (where upto >= total * {x}) as n{p}, min(n) filter (where upto >= total * {x}) as l{p}, coalesce(max(len) filter (where upto >= ref * {x}), 0) as ng{p}, coalesce(min(n) filter (where upto >= ref * {x}), 0) as lg{p}" for x, p in ((0.5, 50), (0.9, 90))) + " from r group by 1, 2")
def reference_fragmentation(spark, sf_dir):
    own = views.hits(spark, sf_dir).groupBy("sample", "locus", "contig").agg(F.sum(F.col("t_end") - F.col("t_start")).alias("length"), F.max("q_size").alias("size"))
    ref = own.groupBy("sample", "locus").agg(F.max("size").alias("ref"))
    return assembly.fragmentation(own.drop("size").join(ref, ["sample", "locus"]), ["sample", "locus"], "ref")


_MID = "t_start + (t_end - t_start) // 2"
_GFF = "contig || chr(9) || 'phylospark' || chr(9) || {f} || chr(9) || ({s} + 1) || chr(9) || {e} || chr(9) || printf('%.3f', floor(wscore * 1000) / 1000) || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=' || hit_id || ';Name=' || locus || ';Identity=' || printf('%.2f', identity) || ';Coverage=' || printf('%.2f', coverage) || ';Depth=' || printf('%.4f', depth) || ';Target=' || target"


@query("k06_gff_blocks", f"with {HITS} " + " union all ".join(f"select sample, hit_id, cast({n} as int) as part, {_GFF.format(f=f, s=s, e=e)} as line from hits" for n, f, s, e in ((0, "'mRNA'", "t_start", "t_end"), (1, "'protein_match'", "t_start", _MID), (2, "'protein_match'", f"({_MID})", "t_end"))))
def gff_blocks(spark, sf_dir):
    half = F.col("t_start") + F.floor((F.col("t_end") - F.col("t_start")) / 2)
    block = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
    rows = views.hits(spark, sf_dir).withColumn("blocks", F.array(block(F.col("t_start"), half), block(half, F.col("t_end"))))
    whole = F.floor(F.col("wscore") * 1000) / 1000.0  # engines differ in how they round the halves
    return hits.gff_block_lines(rows.withColumn("wscore", whole), "protein_match", parent=True)


_GC = lambda s: f"100.0 * ({_GCW.format(s)}) / nullif({_LET.format(s)}, 0)"


@query("a07_full_sample_summary", f"""with {ALIGNMENTS}, one as (select locus, sample, length(trim(sequence, '-')) as lg, length({_BARE}) as lu, length(regexp_replace({_BARE}, '[^MRWSYKVHDBN?]', '', 'g')) as am, {_GC(_BARE)} as gc, {", ".join(f"{_GC(_CODON.format(_BARE, i))} as g{i}" for i in (1, 2, 3))} from alignments where not is_ref),
    st as (select locus, sample, round(avg(lg), 2) as lg, round(avg(lu), 2) as lu, round(avg(am), 2) as am, round(cast(avg(gc) as double), 2) as gc, {", ".join(f"round(cast(avg(g{i}) as double), 2) as g{i}" for i in (1, 2, 3))}, count(*) as copies from one group by 1, 2)
    select sample, count(*) as num_loci, median(lu) as median_len, round(avg(lu), 6) as mean_len, round(sum(lu), 2) as total_len, round(avg(lg - lu), 6) as mean_gaps, round(sum(lg - lu), 2) as total_gaps, round(avg(am), 6) as mean_ambig, round(avg(gc), 6) as mean_gc, {", ".join(f"round(avg(g{i}), 6) as mean_gc_codon{i}" for i in (1, 2, 3))}, median(copies) as median_copies, round(avg(copies), 6) as mean_copies from st group by 1""")
def full_sample_summary(spark, sf_dir):
    return sites.full_sample_summary(views.alignments(spark, sf_dir), ["locus"])


@query("w10_retained_representatives", f"with {_COPIES}, held as (select distinct centroid from clusters where sample in ('s3', 's7')), named as (select cc.*, c.locus, cast(c.length % 10 as double) as wscore, cc.centroid in (select centroid from held) as held from cc join clusters c on c.centroid = cc.centroid and c.member = c.centroid), rk as (select *, row_number() over w as rank, first_value(centroid_length) over w as tl, first_value(sequences) over w as ts from named window w as (partition by locus order by samples desc, centroid_length desc, wscore desc, centroid)) select locus, centroid, rank, samples, centroid_length from rk where rank = 1 or centroid_length >= 0.75 * tl and (sequences >= 0.9 * ts or held)")
def retained_representatives(spark, sf_dir):
    keep = spark.createDataFrame([("s3",), ("s7",)], "sample string")
    rows = views.clusters(spark, sf_dir).withColumn("wscore", (F.col("length") % 10).cast("double"))
    return targets.representatives(rows, ["locus"], depth_share=0.9, score="wscore", retain=keep)


@query("q25_eligible_clusters", f"with {CLUSTERS}, p as (select locus, sample, count(*) as c from clusters group by 1, 2) select locus, count(*) as samples, median(c) as median_copies from p group by 1 having count(*) >= 4 and median(c) <= 50")
def eligible_clusters(spark, sf_dir):
    return targets.eligible_clusters(views.clusters(spark, sf_dir), ["locus"], min_samples=4, max_copies=50)


@query("p08_auto_depth", f"with {CONTIGS} select sample, contig, depth >= 1.5 as mapped, depth >= 1.0001 as unmapped from contigs")
def auto_depth(spark, sf_dir):
    both = assembly.filter_contigs(views.contigs(spark, sf_dir)).withColumnRenamed("accepted", "mapped")
    return assembly.filter_contigs(both, mapped=False).select("sample", "contig", "mapped", F.col("accepted").alias("unmapped"))


@query("q07_adaptor_tips", f"""with {READS}, {_ADAPTORS}, st as (select distinct name as adaptor, substr(sequence, 1, n) as kmer from (select *, unnest(range(5, 8)) as n from adaptors) where n <= length(sequence)),
    nb as (select kmer, min(adaptor) as adaptor from (select adaptor, substr(kmer, 1, p - 1) || b || substr(kmer, p + 1) as kmer from (select *, unnest(range(1, length(kmer) + 1)) as p from st), (select unnest(['a', 'c', 'g', 't']) as b)) group by 1),
    en as (select sample, read_id, n, right(sequence, n) as kmer from (select *, unnest(range(5, 8)) as n from reads) where n <= length(sequence)), ht as (select sample, read_id, max(n) as off, arg_max(adaptor, n) as adaptor from en join nb using (kmer) group by 1, 2)
    select r.sample, r.read_id, ht.adaptor as adaptor, cast(length(sequence) - coalesce(off, 0) as int) as kept from reads r left join ht using (sample, read_id)""")
def adaptor_tips(spark, sf_dir):
    out = reads.trim_adaptor_tips(views.reads(spark, sf_dir), _adaptors(spark, sf_dir), least=5, k=8, distance=1)
    return out.select("sample", "read_id", "adaptor", F.length("sequence").alias("kept"))


@query("q07_two_rounds")
def two_rounds(spark, sf_dir):
    out = reads.trim_adaptors_in_rounds(views.reads(spark, sf_dir), _adaptors(spark, sf_dir), rounds=((15, 11, 2), (13, 9, 1)))
    return out.select("sample", "read_id", "adaptor_1", "adaptor_2", F.length("sequence").alias("kept"))


_POLY = "regexp_replace(regexp_replace(sequence, '^(a{{3,}}|t{{3,}})', ''), '(a{{3,}}|t{{3,}})$', '')".replace("{{", "{").replace("}}", "}")


@query("q07_poly_a", f"with {READS}, l as (select *, length(regexp_extract(sequence, '^(a{{3,}}|t{{3,}})', 1)) as off, {_POLY} as s from reads) select sample, read_id, s as sequence, substr(quality, cast(off + 1 as bigint), length(s)) as quality from l")
def poly_a(spark, sf_dir):
    return reads.trim_poly_a(views.reads(spark, sf_dir), least=3).select("sample", "read_id", "sequence", "quality")


_FRAGMENT = "split_part(read_id, '_', 1) || '_' || cast(split_part(read_id, '_', 2) as bigint) // 2"


@query("q07_even_pairs", f"with {READS}, f as (select *, {_FRAGMENT} as fragment from reads) select sample, read_id, substr(sequence, 1, min(length(sequence)) over (partition by sample, fragment)) as sequence from f")
def even_pairs(spark, sf_dir):
    part = F.split("read_id", "_")
    fragment = F.concat_ws("_", part[0], F.floor(part[1].cast("long") / 2).cast("string"))
    return reads.trim_pairs_evenly(views.reads(spark, sf_dir).withColumn("fragment", fragment)).select("sample", "read_id", "sequence")


@query("q08_contaminants", f"""with {READS}, {_ADAPTORS}, km as (select distinct substr(sequence, i, 7) as k from (select *, unnest(range(1, length(sequence) - 5)) as i from adaptors where length(sequence) >= 7)), bs as (select k from km union select translate(reverse(k), 'acgt', 'tgca') from km),
    nb as (select distinct substr(k, 1, p - 1) || b || substr(k, p + 1) as k from (select *, unnest(range(1, 8)) as p from bs), (select unnest(['a', 'c', 'g', 't']) as b)), hit as (select distinct sample, read_id from (select sample, read_id, substr(sequence, i, 7) as k from (select *, unnest(range(1, length(sequence) - 5)) as i from reads where length(sequence) >= 7)) join nb using (k))
    select sample, read_id from reads anti join hit using (sample, read_id)""")
def contaminants(spark, sf_dir):
    return reads.drop_contaminated(views.reads(spark, sf_dir), _adaptors(spark, sf_dir), k=7, distance=1).select("sample", "read_id")


_CUT6 = f"""k as (select name, substr(sequence, i, 9) as kmer from (select *, unnest(range(1, length(sequence) - 7)) as i from adaptors)), nr as (select distinct kmer from k),
    pl as (select sample, read_id, min(i - 1) as pos from (select sample, read_id, i, substr(sequence, i, 9) as kmer from (select *, unnest(range(1, length(sequence) - 7)) as i from reads where length(sequence) >= 9)) join nr using (kmer) group by 1, 2)"""


@query("a08_qc_report", f"""with {READS}, {_ADAPTORS}, {_CUT6}, al as (select sample, mate, count(*) as n from reads group by 1, 2), bg as (select sample, mate, pos, count(*) as c from pl join reads using (sample, read_id) group by 1, 2, 3), ac as (select sample, mate, round(100.0 * sum(c) over (partition by sample, mate order by pos) / n, 4) as pct from bg join al using (sample, mate)),
    tp as (select sample, round(avg(top), 4) as pct_adaptor from (select sample, mate, max(pct) as top from ac group by 1, 2) group by 1), inn as (select sample, count(*) as reads_in, cast(sum(length(sequence)) as bigint) as bases_in from reads group by 1),
    aft as (select sample, length(sequence) as n, floor(list_sum({_Q}) / cast(length(quality) as double)) as q, floor(coalesce(100.0 * length(regexp_replace(sequence, '[^gc]', '', 'g')) / length(sequence), 0) + 0.5) as gc from reads where length(sequence) >= 100),
    ou as (select sample, count(*) as reads_out, cast(sum(n) as bigint) as bases_out, round(100.0 * count(*) filter (where q >= 20) / count(*), 4) as pct_reads_q20, round(100.0 * count(*) filter (where q >= 30) / count(*), 4) as pct_reads_q30, round(avg(gc), 4) as mean_gc from aft group by 1)
    select sample, reads_in, bases_in, coalesce(reads_out, 0) as reads_out, coalesce(bases_out, 0) as bases_out, pct_reads_q20, pct_reads_q30, mean_gc, round(100.0 * coalesce(reads_out, 0) / reads_in, 4) as pct_reads, round(100.0 * coalesce(bases_out, 0) / bases_in, 4) as pct_bases,
      round(100.0 * (bases_out / cast(reads_out as double)) / (bases_in / cast(reads_in as double)), 4) as pct_mean_length, pct_adaptor from inn left join ou using (sample) left join tp using (sample)""")
def qc_report(spark, sf_dir):
    r = views.reads(spark, sf_dir)
    content = reads.adaptor_content(r, reads.trim_adaptors(r, _adaptors(spark, sf_dir), k=9, distance=0))
    return reads.qc_report(r, r.where(F.length("sequence") >= 100), content)


@query("q12_near_deduplicated")
def near_deduplicated(spark, sf_dir):
    return similarity.deduplicate_near(views.contigs(spark, sf_dir), ["sample"], name="contig", save=_saver(spark))


@query("s02_fastq_round_trip", f"with {READS} select sample, read_id, sequence, quality from reads")
def fastq_round_trip(spark, sf_dir):
    path = shared_folder(spark, "fastq")
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id", F.lit(" made")), "sequence", F.lit("+"), "quality")
    views.reads(spark, sf_dir).select("sample", record.alias("value")).write.partitionBy("sample").text(path)
    got = readers.read_fastq(spark, f"{path}/*")
    return got.select(F.regexp_extract("src_file", "sample=([^/]*)", 1).alias("sample"), "read_id", "sequence", "quality")


@query("s03_paired_files", "with f as (select c_custkey as k, 's' || c_custkey as s from customer) select case when k % 2 = 0 then s || '_L1' else s end as sample, case when k % 2 = 0 then '/d/' || s || '_L1_R1.fq' else '/d/' || s || '_R1_x.fq' end as r1, case when k % 3 > 0 then case when k % 2 = 0 then '/d/' || s || '_L1_R2.fq' else '/d/' || s || '_R2_x.fq' end end as r2 from f")
def paired_files(spark, sf_dir):
    k = F.col("k").cast("string")
    even = F.col("k") % 2 == 0
    name = lambda r: F.when(even, F.concat(F.lit("/d/s"), k, F.lit(f"_L1_{r}.fq"))).otherwise(F.concat(F.lit("/d/s"), k, F.lit(f"_{r}_x.fq")))
    lone = F.concat(F.lit("/d/a__"), k, F.lit("_R1.fq"))  # names with the separator don't count
    own = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return readers.pair_files(own.select(F.explode(F.array_compact(F.array(name("R1"), F.when(F.col("k") % 3 > 0, name("R2")), lone))).alias("path")))


def _gff_rows(spark, sf_dir):
    """Two exons a long contig with phases, on the strand that its length picks; some under a second name too."""
    c = views.contigs(spark, sf_dir).where("length >= 400")
    minus = F.col("length") % 2 == 1
    line = lambda kind, s, e, phase, key: F.concat_ws("\t", "contig", F.lit("x"), F.lit(kind), F.lit(str(s)), F.lit(str(e)), F.lit("."), F.when(minus, "-").otherwise("+"), F.lit(phase), F.concat(F.lit(key), "contig"))
    second = F.col("length") % 3 == 0
    lines = [line("CDS", 11, 190, "1", "ID=q;protein_id=p"), line("CDS", 251, 330, "2", "protein_id=p"), line("gene", 1, 390, ".", "ID=g")]
    lines += [F.when(second, line("CDS", 11, 190, "1", "Parent=r")), F.when(second, line("cds", 251, 330, "2", "Parent=r"))]
    return c.select(F.explode(F.array_compact(F.array(*lines))).alias("value"))


def _gff_cds(spark, sf_dir):
    path = shared_folder(spark, "gff")
    _gff_rows(spark, sf_dir).write.text(path)
    return readers.read_gff_cds(spark, path)


_GFF_OF = f"{CONTIGS}, c as (select contig, length, length % 2 = 1 as minus, case when length % 2 = 1 then '-' else '+' end as strand, upper(substr(sequence, 11 + case when length % 2 = 1 then 0 else 1 end, 180 - case when length % 2 = 1 then 0 else 1 end)) as x1, upper(substr(sequence, 251, 80 - case when length % 2 = 1 then 2 else 0 end)) as x2 from contigs where length >= 400)"


@query("s05_gff_cds", f"with {_GFF_OF} " + " union all ".join(f"select contig as seq_id, cast({s} as int) as start, cast({e} as int) as \"end\", strand, cast({f} as int) as shift, '{n}' || contig as cds_id from c where {w}" for s, e, f in ((11, 190, 1), (251, 330, 2)) for n, w in (("p", "true"), ("r", "length % 3 = 0"))))
def gff_cds(spark, sf_dir):
    return _gff_cds(spark, sf_dir)


_RC = "translate(reverse({0}), 'ACGT', 'TGCA')"


@query("p12_cds_exons", f"with {_GFF_OF} select 'p' || contig as cds_id, strand, '[' || contig || case when minus then ':251-330,11-190:-]' else ':11-190,251-330:+]' end as description, case when minus then {_RC.format('(x1 || x2)')} else x1 || x2 end as sequence, cast(2 as int) as exons, cast(1 as int) as long_exons, cast(length(x1) as int) as long_exons_len, cast(1 as int) as short_exons, cast(length(x2) as int) as short_exons_len, cast(320 as int) as gene_len, cast(320 - length(x1) - length(x2) as int) as introns_len from c")
def cds_exons(spark, sf_dir):
    genome = views.contigs(spark, sf_dir).select(F.col("contig").alias("name"), F.upper("sequence").alias("sequence"))
    return readers.read_cds_exons(_gff_cds(spark, sf_dir), genome).drop("seq_id")


@query("p12_split_exons", f"with {_GFF_OF} " + " union all ".join(f"select 'p' || contig || '_exon' || case when minus then {3 - n} else {n} end as name, '[' || contig || ':{p}:' || strand || ']' as description, case when minus then {_RC.format(x)} else {x} end as sequence, length({x}) >= 120 as long from c" for n, p, x in ((1, "11-190", "x1"), (2, "251-330", "x2"))))
def split_exons(spark, sf_dir):
    genome = views.contigs(spark, sf_dir).select(F.col("contig").alias("name"), F.upper("sequence").alias("sequence"))
    return readers.split_exons(_gff_cds(spark, sf_dir), genome)


@query("s06_psl_hits", f"with {HITS} select hit_id, cast(matches as int) as matches, strand, cast(target as varchar) as q_name, cast(contig as varchar) as t_name, cast(q_start as int) as q_start, cast(q_end as int) as q_end, cast(t_start as int) as t_start, cast(t_end as int) as t_end, cast(1 as int) as block_count, round(wscore, 6) as wscore from hits")
def psl_hits(spark, sf_dir):
    path = shared_folder(spark, "psl")
    c, zero = F.col, F.lit(0)
    target = F.concat_ws("|", c("contig").cast("string"), c("hit_id").cast("string"))  # so that a row is known again
    last = lambda x: F.concat(x.cast("string"), F.lit(","))
    fields = [c("matches"), c("mismatches"), zero, zero, c("q_num_insert"), zero, zero, zero, c("strand"), c("target"), c("q_size"), c("q_start"), c("q_end"), target, c("t_size"), c("t_start"), c("t_end"), F.lit(1), last(c("q_end") - c("q_start")), last(c("q_start")), last(c("t_start")), c("wscore")]
    views.hits(spark, sf_dir).select(F.concat_ws("\t", *[f.cast("string") for f in fields]).alias("value")).write.text(path)
    part = F.split("t_name", "\\|")
    return readers.read_psl(spark, path).select(part[1].cast("long").alias("hit_id"), "matches", "strand", "q_name", part[0].alias("t_name"), "q_start", "q_end", "t_start", "t_end", "block_count", F.round("wscore", 6).alias("wscore"))


@query("s11_sam_records", f"with {READS} select read_id as name, length(sequence) || 'M' as cigar, sequence from reads where mate = 1")
def sam_records(spark, sf_dir):
    path = shared_folder(spark, "sam")
    n = F.length("sequence").cast("string")
    cigar = F.when(F.col("mate") == 1, F.concat(n, F.lit("M"))).otherwise(F.concat(F.lit("3S"), n, F.lit("M")))
    line = F.concat_ws("\t", "read_id", F.lit("0"), F.lit("c"), F.lit("1"), F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), "sequence", F.lit("*"))
    rows = views.reads(spark, sf_dir).select(F.explode(F.array(line, F.lit("@PG\tx"))).alias("value"))
    rows.write.text(path)
    return readers.unclipped(readers.read_sam(spark, path))


_BAITS = f"{CONTIGS}, bt as (select contig as name, i, (i - 1) // 60 + 1 as bait_no, substr(sequence, i, 120) as bait from (select *, unnest(range(1, length - 118, 60)) as i from contigs where length >= 120))"


def _baits(spark, sf_dir):
    return targets.tile(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), step=60)


@query("q15_exonic_baits", f"with {_BAITS}, ex as (select upper(substr(sequence, 31, 200)) as s from contigs where length >= 400 and cast(contig as bigint) % 2 = 0) select name, bait_no from bt where exists (select 1 from ex where contains(ex.s, upper(bt.bait)) or contains(ex.s, translate(reverse(upper(bt.bait)), 'ACGT', 'TGCA')))")
def exonic_baits(spark, sf_dir):
    exons = views.contigs(spark, sf_dir).where("length >= 400 and cast(contig as bigint) % 2 = 0").select(F.col("contig").alias("exon"), F.substring("sequence", 31, 200).alias("sequence"))
    found = similarity.exonic(_baits(spark, sf_dir), exons, k=60)  # two ends of 60 bases are the whole bait
    return found.select("name", "bait_no")


@query("q17_masked_baits", f"""with {_BAITS}, dist as (select distinct bait from bt), wn as (select bait, p, substr(bait, p, 40) as w from (select bait, unnest([1, 21, 41, 61, 81]) as p from dist)), tr as (select bait, p, substr(w, i, 3) as t, count(*) as n from (select *, unnest(range(1, 39)) as i from wn) group by 1, 2, 3), sc as (select bait, p from tr group by 1, 2 having sum(n * (n - 1) / 2.0) / 37 > 1.2),
    ps as (select bait, i, upper(substr(bait, i, 1)) as c from (select bait, unnest(range(1, 121)) as i from dist)),
    lw as (select ps.bait, ps.i, case when exists (select 1 from sc where sc.bait = ps.bait and sc.p <= ps.i and ps.i < sc.p + 40) then lower(c) else c end as c from ps), ms as (select bait, string_agg(c, '' order by i) as masked from lw group by 1)
    select name, bait_no, masked as bait from bt join ms using (bait)""")
def masked_baits(spark, sf_dir):
    return similarity.mask_low_complexity(_baits(spark, sf_dir), limit=1.2).select("name", "bait_no", "bait")


@query("q18_clustered_baits")
def clustered_baits(spark, sf_dir):
    """Baits of all contigs, 20 bases apart."""
    own = targets.tile(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), step=20)
    rows = own.select(F.concat_ws("_", "name", F.lpad(F.col("bait_no").cast("string"), 8, "0")).alias("name"), F.col("bait").alias("sequence"))
    return similarity.thin_clustered_baits(rows, save=_saver(spark))


@query("s15_reference_targets", f"with {CONTIGS} select contig || '-' || sample as target, sample as locus, 'NT' as seq_type, length(sequence) as bases from contigs where sequence <> ''")
def reference_targets(spark, sf_dir):
    rows = views.contigs(spark, sf_dir).where("length > 0").select(F.concat_ws("-", "contig", "sample").alias("name"), "sequence", F.lit("f").alias("src_file"))
    found = readers.reference_targets(rows)
    return found.select("target", "locus", "seq_type", F.length("sequence").alias("bases"))


def _located(spark, sf_dir):
    return views.contigs(spark, sf_dir).where("length >= 60").select(F.concat_ws("-", "contig", "sample").alias("name"), F.col("sample").alias("locus"), "sample", "sequence")


@query("q19_clustered_targets")
def clustered_targets(spark, sf_dir):
    """Contigs as targets of their source's locus, with as many baits as 60 bases apart give."""
    own = _located(spark, sf_dir)
    of = views.contigs(spark, sf_dir).select(F.col("contig").alias("name"), F.col("sample").alias("locus"))
    baits = _baits(spark, sf_dir).join(of, "name").groupBy("locus").agg(F.count(F.lit(1)).alias("baits"))
    return references.target_set(own.select("name", "locus", "sequence"), baits, remove_ambiguous=False, save=_saver(spark))[0]


@query("q20_two_rounds")
def two_rounds(spark, sf_dir):
    """References from contigs that at least two sources share."""
    own = _located(spark, sf_dir).select("name", "sample", "sequence")
    return references.reference_candidates(own, min_samples=2, max_copies=5.0, min_length=200, save=_saver(spark))


@query("k02_locus_files", f"with {ALIGNMENTS} select locus, seq_name as name, sequence from alignments")
def locus_files(spark, sf_dir):
    """Every alignment written to a file of its locus's name, and all files read again."""
    path = shared_folder(spark, "loci")
    files.write_fasta_files(views.alignments(spark, sf_dir).select("locus", F.col("seq_name").alias("name"), "sequence"), path, width=50)
    found = readers.read_fasta(spark, path)
    return found.select(F.regexp_extract("src_file", r"([^/]+)\.fasta$", 1).alias("locus"), "name", "sequence")


@query("k03_nexus_files", f"""with {ALIGNMENTS}, z as (select locus, count(*) as n, max(length(sequence)) as w, max(length(seq_name)) as p from alignments group by 1), b as (select locus, seq_name, sequence, p, unnest(range(0, 3)) as k from alignments join z using (locus))
    select locus || '.nex' as file, rpad(seq_name, cast(p as int), ' ') || ' ' || substr(sequence, cast(k * 50 + 1 as bigint), 50) as line from b union all select locus || '.nex', unnest(['#NEXUS', 'BEGIN DATA;', 'DIMENSIONS NTAX=' || n || ' NCHAR=' || w || ';', 'FORMAT INTERLEAVE DATATYPE=DNA GAP=- MISSING=?;', 'MATRIX', '', '', '', ';', 'END;']) from z""")
def nexus_files(spark, sf_dir):
    """Interleaved NEXUS files of every locus, read again line by line."""
    path = shared_folder(spark, "nexus")
    files.write_nexus_files(views.alignments(spark, sf_dir).select("locus", F.col("seq_name").alias("name"), "sequence"), path, width=50)
    lines = spark.read.text(path).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file"), F.col("value").alias("line"))
    return lines


@query("q07_mate_overlap")
def mate_overlap(spark, sf_dir):
    """Windows two by two as mates: each read's fragment by its mate's facing bases."""
    part = F.split("read_id", "_")
    fragment = F.concat_ws("_", part[0], F.floor(part[1].cast("long") / 2).cast("string"))
    return reads.trim_mate_overlap(views.reads(spark, sf_dir).withColumn("fragment", fragment)).select("sample", "read_id", "insert", F.length("sequence").alias("kept"))


_HEADERS = f"""recs as (select sample as src_file, cast(contig as bigint) as ord, style, sequence, case style when 0 then 'NODE_' || contig || '_length_' || length || '_cov_' || depth when 1 then 'k141_' || contig when 2 then 'Contig_' || contig || '_' || depth || case when cast(contig as bigint) % 5 = 0 then '_Circ' else '' end else 'scaffold' || contig end as name,
    case style when 1 then 'flag=1 multi=' || depth || ' len=' || length when 3 then 'as it is' else '' end as description from (select *, length(sample) * 7 % 4 as style from contigs where length > 0))"""


@query("p01_normalised_headers", f"""with {CONTIGS}, {_HEADERS} select src_file, sequence, case style when 0 then 'node' when 1 then 'flag' when 2 then 'contig' else 'unknown' end as assembler, case when style in (0, 3) then description else '' end as description,
    case style when 1 then 'NODE_' || ord || '_length_' || length(sequence) || '_cov_' || regexp_extract(description, 'multi=([0-9.]+)', 1) || '_k_141_flag_1' when 2 then 'NODE_' || ord || '_length_' || length(sequence) || '_cov_' || regexp_extract(name, '_([0-9.]+)(_Circ)?$', 1) || case when ord % 5 = 0 then '_circular' else '' end else name end as name from recs""")
def normalised_headers(spark, sf_dir):
    """Contigs of every source under one assembler's headers, by the length of the source's name."""
    c, style = F.col, F.length("sample") * 7 % 4
    depth, size = c("depth").cast("string"), c("length").cast("string")
    own = views.contigs(spark, sf_dir).where("length > 0").withColumn("style", style)
    circular = F.when(c("contig").cast("long") % 5 == 0, "_Circ").otherwise("")
    name = F.when(c("style") == 0, F.concat(F.lit("NODE_"), "contig", F.lit("_length_"), size, F.lit("_cov_"), depth)).when(c("style") == 1, F.concat(F.lit("k141_"), "contig")).when(c("style") == 2, F.concat(F.lit("Contig_"), "contig", F.lit("_"), depth, circular)).otherwise(F.concat(F.lit("scaffold"), "contig"))
    described = F.when(c("style") == 1, F.concat(F.lit("flag=1 multi="), depth, F.lit(" len="), size)).when(c("style") == 3, "as it is").otherwise("")
    records = own.select(c("sample").alias("src_file"), c("contig").cast("long").alias("ord"), name.alias("name"), described.alias("description"), "sequence")
    return readers.import_assemblies(records).select("src_file", "sequence", "assembler", "description", "name")
