"""Queries over tables of many samples, their projections, and curated clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import assembly, merge, sites, stitch
from phylospark.operators import targets as target_ops
from phylospark.sources import readers, writers

from . import views
from .q_similarity import shared_folder
from .registry import query
from .views import ALIGNMENTS, CLUSTERS, CONTIGS, EXTRACTION, HITS, READS

K = ["locus"]


def _written(spark, frame, key: str, values: list[str], schema: str):
    """Tables of single samples, written one folder each and read back."""
    out = []
    for v in values:
        path = shared_folder(spark, "one")
        writers.write_table(frame.where(F.col(key) == v), path)
        out.append(readers.read_table(spark, path, schema))
    return out


@query("u01_merged_tables", f"with {EXTRACTION} select sample, marker, locus, wscore, case when marker = 'm0' then coverage end as coverage from extraction")
def merged_tables(spark, sf_dir):
    e = views.extraction(spark, sf_dir).select("sample", "marker", "locus", "wscore", "coverage")
    full = _written(spark, e, "marker", ["m0"], "sample string, marker string, locus string, wscore double, coverage double")
    bare = _written(spark, e.drop("coverage"), "marker", ["m1", "m2"], "sample string, marker string, locus string, wscore double")
    return merge.merge_tables([*full, *bare])


@query("k09_merged_assembly_stats", f"with {CONTIGS} select sample, count(*) as n_contigs, cast(sum(length) as bigint) as total_length, round(avg(depth), 4) as mean_depth from contigs group by 1")
def merged_assembly_stats(spark, sf_dir):
    c = views.contigs(spark, sf_dir)
    stats = assembly.assembly_stats(c, ["sample"]).select("sample", "n_contigs", "total_length", "mean_depth")
    path = shared_folder(spark, "stats")
    stats.write.partitionBy("sample").parquet(path)  # one table, a folder a sample, in place of a file each
    return spark.read.parquet(path).select(F.col("sample").cast("string").alias("sample"), "n_contigs", "total_length", "mean_depth")


@query("k10_merged_extraction_stats", f"with {EXTRACTION} select sample, marker, count(*) as copies, count(distinct locus) as loci, round(avg(wscore), 6) as mean_wscore from extraction group by 1, 2")
def merged_extraction_stats(spark, sf_dir):
    path = shared_folder(spark, "ext")
    views.extraction(spark, sf_dir).write.partitionBy("sample").parquet(path)
    return spark.read.parquet(path).groupBy("sample", "marker").agg(F.count(F.lit(1)).alias("copies"), F.count_distinct("locus").alias("loci"), F.round(F.avg("wscore"), 6).alias("mean_wscore"))


@query("k02_routed_fasta", f"with {ALIGNMENTS} select locus, seq_name as name, replace(sequence, '-', '') as sequence from alignments where not is_ref and replace(sequence, '-', '') <> '' and locus like '%\\_1' escape '\\'")
def routed_fasta(spark, sf_dir):
    path = shared_folder(spark, "routed")
    rows = views.alignments(spark, sf_dir).where("not is_ref and locus like '%\\_1'")
    writers.write_fasta(rows.select("locus", F.col("seq_name").alias("name"), F.regexp_replace("sequence", "-", "").alias("sequence")), path, width=0, partition_by=["locus"])
    got = readers.read_fasta(spark, f"{path}/*")
    return got.select(F.regexp_extract("src_file", "locus=([^/]*)", 1).alias("locus"), "name", "sequence")


@query("k12_annotated_assembly", f"with {CONTIGS}, {HITS}, h as (select 's' || (cast(contig as bigint) % 20) as sample, contig, count(*) as hits, count(distinct locus) as loci from (select cast(contig as varchar) as contig, locus from hits) group by 1, 2), c as (select 's' || (cast(contig as bigint) % 20) as sample, contig, length from contigs) select sample, contig, length, coalesce(hits, 0) as hits, coalesce(loci, 0) as loci, case when coalesce(hits, 0) > 0 then 'hit' else 'leftover' end as part from c left join h using (sample, contig)")
def annotated_assembly(spark, sf_dir):
    group = F.concat(F.lit("s"), (F.col("contig").cast("long") % 20).cast("string"))
    c = views.contigs(spark, sf_dir).select(group.alias("sample"), "contig", "length")
    h = views.hits(spark, sf_dir).select(F.col("contig").cast("string").alias("contig"), "locus").withColumn("sample", group)
    return merge.annotated_assembly(c, h)


_MARKED = f"{HITS}, mk as (select *, 'm' || (locus % 3) as marker from hits)"


@query("k12_merged_gff", f"with {_MARKED} select sample, marker, cast(contig as varchar) as contig, t_start as start, contig || chr(9) || 'phylospark' || chr(9) || 'match' || chr(9) || (t_start + 1) || chr(9) || t_end || chr(9) || printf('%.2f', identity) || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=' || hit_id || ';Name=' || locus || '%20' || target || ';WScore=' || printf('%.5f', wscore) as line from mk")
def merged_gff(spark, sf_dir):
    return merge.merged_annotation(_marked(spark, sf_dir))[0]


@query("k12_marker_statistics", f"with {_MARKED} select sample, marker, count(*) as hits, count(distinct locus) as loci, count(distinct contig) as contigs, cast(sum(abs(t_end - t_start)) as bigint) as bases from mk group by 1, 2")
def marker_statistics(spark, sf_dir):
    return merge.merged_annotation(_marked(spark, sf_dir))[1]


def _marked(spark, sf_dir):
    return views.hits(spark, sf_dir).withColumn("marker", F.concat(F.lit("m"), (F.col("locus") % 3).cast("string")))


_FUNNEL = f"{READS}, st as (select sample, 'input' as stage, length(sequence) as n from reads union all select sample, 'round1', length(sequence) from reads where length(sequence) >= 100 union all select sample, 'clean', length(sequence) from reads where length(sequence) >= 151), ag as (select sample, stage, count(*) as reads, cast(sum(n) as bigint) as bases from st group by 1, 2)"
_LOST = ", ".join(f"round(coalesce(100.0 * ({c}_{a} - {c}_{b}) / nullif({c}_{a}, 0), 0), 4) as pct_{c}_lost_{b}" for a, b in (("input", "round1"), ("round1", "clean")) for c in ("reads", "bases"))


@query("a12_read_funnel", f"with {_FUNNEL}, w as (select sample, " + ", ".join(f"max({c}) filter (where stage = '{s}') as {c}_{s}" for s in ("input", "round1", "clean") for c in ("reads", "bases")) + f" from ag group by 1) select *, {_LOST} from w")
def read_funnel(spark, sf_dir):
    n = F.length("sequence")
    r = views.reads(spark, sf_dir).select("sample", n.alias("n"))
    r = r.select("sample", "n", F.explode(F.array_compact(F.array(F.lit("input"), F.when(F.col("n") >= 100, "round1"), F.when(F.col("n") >= 151, "clean")))).alias("stage"))
    counted = r.groupBy("sample", "stage").agg(F.count(F.lit(1)).alias("reads"), F.sum("n").alias("bases"))
    return merge.read_funnel(counted, ["input", "round1", "clean"])


@query("a16_locus_data", f"with {CLUSTERS}, own as (select *, 'N' || (centroid % 7) as locus_name from clusters), p as (select locus_name, sample, count(*) as c from own group by 1, 2), i as (select locus_name, array_to_string(list_sort(list(distinct locus)), ',') as includes from own group by 1) select locus_name, cast(sum(c) as bigint) as num_seqs, count(*) as num_samples, median(c) as median_copies, any_value(includes) as includes from p join i using (locus_name) group by 1")
def locus_data(spark, sf_dir):
    c = views.clusters(spark, sf_dir)
    names = c.select("centroid").distinct().withColumn("locus_name", F.concat(F.lit("N"), (F.col("centroid") % 7).cast("string")))
    return merge.locus_data(c, names)


@query("q23_new_targets", f"with {CLUSTERS}, own as (select *, 'N' || (centroid % 7) as locus_name from clusters), p as (select locus_name, sample, count(*) as c from own group by 1, 2), d as (select locus_name, cast(sum(c) as bigint) as s, count(*) as n, median(c) as m from p group by 1), l as (select distinct centroid, locus_name from own) select 'v_H' || centroid || '-' || locus_name as name, '[copies=' || m || '] [samples=' || n || '] [seqs=' || s || ']' as description from l join d using (locus_name)")
def new_targets(spark, sf_dir):
    c = views.clusters(spark, sf_dir)
    names = c.select("centroid").distinct().withColumn("locus_name", F.concat(F.lit("N"), (F.col("centroid") % 7).cast("string")))
    data = merge.locus_data(c, names).join(names.withColumn("member", F.concat_ws("__", F.lit("v"), F.col("centroid").cast("string"))), "locus_name")
    return merge.new_targets(data)


@query("j08_chosen_exons", "select l_orderkey, l_linenumber, l_suppkey as cds_id, cast(l_quantity * 10 as bigint) as length from lineitem where l_quantity * 10 >= 120 and l_suppkey in (select s_suppkey from supplier where s_suppkey % 3 = 0)")
def chosen_exons(spark, sf_dir):
    exons = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("cds_id"), (F.col("l_quantity") * 10).cast("long").alias("length"))
    chosen = views.table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("cds_id"))
    return merge.exons_of(exons, chosen, 120)


@query("j08_coding_loci", f"with {CLUSTERS} select locus, bool_or(member % 31 = 0) as coding from clusters group by 1")
def coding_loci(spark, sf_dir):
    c = views.clusters(spark, sf_dir).withColumnRenamed("member", "name")
    return merge.coding_loci(c, c.where("name % 31 = 0").select(F.col("name").alias("cds_id")))


_TILES = f"{CONTIGS}, tiles as (select contig as name, (i - 1) // 60 + 1 as bait_no, sample, substr(s, i, 120) as bait from (select *, unnest(range(1, length(s) - 118, 60)) as i from (select contig, sample, upper(sequence) as s from contigs where length >= 120)))"


@query("u03_union_of_baits", f"with {_TILES} select name, cast(bait_no as int) as bait_no, bait, cast(name as bigint) % 4 = 0 as coding from tiles")
def union_of_baits(spark, sf_dir):
    tiles = target_ops.tile(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), step=60).select("name", "bait_no", "bait")
    coding = F.col("name").cast("long") % 4 == 0
    return merge.union_baits(tiles.where(coding), tiles.where(~coding))


@query("u06_excluded_samples", f"with {CLUSTERS} select member, sample from clusters where sample not in ('s1', 's2', 's3') or sample = 's2'")
def excluded_samples(spark, sf_dir):
    one = lambda names: spark.createDataFrame([(n,) for n in merge.sample_list(names, species=False)], "sample string")
    return merge.without_samples(views.clusters(spark, sf_dir), one("s1,s2,s3"), one("s2")).select("member", "sample")


@query("p11_organelle_cap", f"with {CONTIGS}, m as (select contig, length * 600 as length, case when cast(contig as bigint) % 3 = 0 then 'PTD' when cast(contig as bigint) % 3 = 1 then 'MIT' else 'NUC' end as marker from contigs) select contig, marker from m where marker = 'NUC' or marker = 'PTD' and length <= 550000 or marker = 'MIT' and length <= 1000000")
def organelle_cap(spark, sf_dir):
    c = views.contigs(spark, sf_dir)
    n = F.col("contig").cast("long") % 3
    return merge.cap_organelles(c.select("contig", (F.col("length") * 600).alias("length"), F.when(n == 0, "PTD").when(n == 1, "MIT").otherwise("NUC").alias("marker"))).select("contig", "marker")


@query("p13_fixed_residues", f"with {ALIGNMENTS}, k as (select seq_name, lower(sequence) || '*' as s, case when rank % 3 = 0 then 'AA' when rank % 3 = 1 then 'NT' else 'GE' end as kind from alignments) select seq_name, case kind when 'AA' then replace(s, '*', 'X') when 'GE' then replace(s, 'n', '-') else s end as sequence from k")
def fixed_residues(spark, sf_dir):
    kind = F.when(F.col("rank") % 3 == 0, "AA").when(F.col("rank") % 3 == 1, "NT").otherwise("GE")
    return views.alignments(spark, sf_dir).select("seq_name", merge.fix_residues(F.concat(F.lower("sequence"), F.lit("*")), kind).alias("sequence"))


@query("p16_outgroup_first", f"with {ALIGNMENTS}, o as (select *, list_position(['s9', 's3', 's12'], sample) as r from alignments) select locus, cast(row_number() over (partition by locus order by r nulls last, seq_name) as int) as place, seq_name, target as description from o")
def outgroup_first(spark, sf_dir):
    aln = views.alignments(spark, sf_dir)
    turned = aln.withColumn("seq_name", F.when(F.col("rank") % 2 == 0, F.concat(F.lit("_R_"), "seq_name")).otherwise(F.col("seq_name")))
    outgroup = spark.createDataFrame(list(enumerate(("s9", "s3", "s12"))), "rank int, sample string")
    return merge.outgroup_first(turned.select("locus", "seq_name", "sample"), outgroup, K, aln.withColumnRenamed("target", "description"))


@query("p17_prefixed_names", f"with {CONTIGS} select sample || '__' || contig as name, sequence from contigs")
def prefixed_names(spark, sf_dir):
    return merge.prefix_samples(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name")).select("name", "sequence")


@query("p18_stage_key", "select o_orderkey, case when o_orderkey % 2 = 0 then 'trimmed' else 'untrimmed' end || '-' || lower(o_orderstatus) || '-' || case when o_custkey % 2 = 0 then 'w_refs' else 'no_refs' end as stage_key, 'm' || o_custkey % 3 as marker, o_orderpriority as format from orders")
def stage_key(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    path = F.concat_ws(" / ", F.lit("trimmed"), F.lower("o_orderstatus"), F.concat(F.lit("m"), (F.col("o_custkey") % 3).cast("string")), "o_orderpriority")
    return merge.split_path(o.withColumn("path", path)).select("o_orderkey", merge.stage_key(F.col("o_orderkey") % 2 == 0, F.col("filter"), F.col("o_custkey") % 2 == 0).alias("stage_key"), "marker", "format")


_ASM = f"{CONTIGS}, b as (select sample, length, depth, contig, sum(length) over w as upto, row_number() over w as rn, sum(length) over (partition by sample) as total from contigs window w as (partition by sample order by length desc, contig rows between unbounded preceding and current row)), n as (select sample, max(length) filter (where upto >= total * 0.5) as n50, min(rn) filter (where upto >= total * 0.5) as l50 from b group by 1), s as (select sample, count(*) as c, cast(sum(length) as bigint) as t, min(length) as lo, max(length) as hi, round(100.0 * sum(length(regexp_replace(sequence, '[^gc]', '', 'g'))) / nullif(sum(length(regexp_replace(sequence, '[^acgt]', '', 'g'))), 0), 4) as gc, round(avg(depth), 4) as d from contigs group by 1)"


@query("p20_assembly_summary", f"with {_ASM} select sample as \"Sample\", c as \"#Contigs\", t as \"Total Length (bp)\", lo as \"Shortest Contig (bp)\", hi as \"Longest Contig (bp)\", n50 as \"N50 (bp)\", l50 as \"L50\", gc as \"GC Content (%)\", d as \"Mean Depth (x)\" from s join n using (sample)")
def assembly_summary(spark, sf_dir):
    c = views.contigs(spark, sf_dir)
    stats = lambda f, stage: assembly.assembly_stats(f, ["sample"]).join(assembly.nx_lx(f, ["sample"], (0.5,)), "sample").withColumn("stage", F.lit(stage))
    return merge.assembly_summary(merge.merge_tables([stats(c.where("length > 10"), "before"), stats(c, "after")]))


@query("p21_populated_percentage", "select l_linestatus as level, cast(l_discount * 100 as double) as percentage_of_total from lineitem")
def populated_column(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem")
    return merge.populated_percentage(items.select(F.col("l_linestatus").alias("level"), F.lit(None).cast("double").alias("percentage_of_total"), (F.col("l_discount") * 100).cast("double").alias("percentage_of_deduplicated")))


@query("a23_retained_exons", "with e as (select p_partkey as cds_id, p_partkey % 13 as locus, 100 + p_partkey % 700 as retained, 1000 + p_partkey % 17 as exons_len, (p_partkey % 10) / 10.0 as p from part), r as (select *, row_number() over (partition by locus order by retained, cds_id) as k, count(*) over (partition by locus) as n from e) select locus, cds_id, round(100.0 * (retained / cast(exons_len as double)), 2) as perc_exons_retained, round(100.0 * (cast(p as double) * (retained / cast(exons_len as double))), 2) as perc_long_exons_retained, round(cast(p as double) * (retained / cast(exons_len as double)) * exons_len, 0) as len_long_exons_retained from r where k = greatest(1, n // 2)")
def retained_exons(spark, sf_dir):
    k = F.col("p_partkey")
    part = views.table(spark, sf_dir, "part").select(k.alias("cds_id"), (k % 13).alias("locus"), (100 + k % 700).alias("retained"), (1000 + k % 17).alias("exons_len"), ((k % 10) / 10.0).alias("prop_long_exons"))
    return merge.retained_exons(part.select("locus", "cds_id", "retained"), part.drop("locus", "retained"), K)


_CUT = f"{ALIGNMENTS}, en as (select locus, sample, length(sequence) - length(ltrim(sequence, '-')) as a, length(rtrim(sequence, '-')) as b from alignments), dp as (select locus, p as pos, count(*) filter (where sample not in ('s5', 's6') and a <= p and p < b) as d, count(*) filter (where sample not in ('s5', 's6')) as n from (select *, unnest(range(0, 120)) as p from en) group by 1, 2), sp as (select locus, min(pos) as f, max(pos) as l from dp where d >= floor(n * 0.8) and n > 0 group by 1), ct as (select locus, seq_name, sample, substr(sequence, cast(f + 1 as bigint), cast(l - f + 1 as bigint)) as s from alignments join sp using (locus))"


@query("q24_curated_clusters", f"with {_CUT}, k as (select * from ct where length(replace(s, '-', '')) >= 60) select locus, max(length(s)) as width, count(*) as rows, count(distinct sample) as samples, count(distinct case when sample in ('s1', 's2', 's3') then sample end) as focal, count(distinct case when sample in ('s4') then sample end) as outgroup, count(distinct case when sample in ('s5', 's6') then sample end) as addon from k group by 1")
def curated_clusters(spark, sf_dir):
    one = lambda *names: spark.createDataFrame([(n,) for n in names], "sample string")
    return merge.curate_clusters(views.alignments(spark, sf_dir), one("s1", "s2", "s3"), one("s4"), one("s5", "s6"), K, bait_length=60)


@query("q24_curated_rows", f"with {_CUT} select locus, seq_name, s as sequence from ct where length(replace(s, '-', '')) >= 60")
def curated_rows(spark, sf_dir):
    addons = spark.createDataFrame([("s5",), ("s6",)], "sample string")
    return merge.curated_rows(views.alignments(spark, sf_dir), addons, K, bait_length=60).select("locus", "seq_name", "sequence")


@query("j16_trimmed_codons", f"with {ALIGNMENTS}, fl as (select locus, seq_name, i - 1 as pos, substr(sequence, i, 1) as c from (select *, unnest(range(1, 121)) as i from alignments)), kp as (select locus, pos from fl group by 1, 2 having count(*) filter (where c = '-') / cast(count(*) as double) <= 0.15) select locus, seq_name, string_agg(case when c = '?' then '---' else repeat(c, 3) end, '' order by pos) as sequence from fl join kp using (locus, pos) group by 1, 2")
def trimmed_codons(spark, sf_dir):
    aa = views.alignments(spark, sf_dir).select("locus", "seq_name", "sequence")
    nt = aa.withColumn("sequence", F.array_join(F.transform(F.split("sequence", ""), lambda c: F.repeat(c, F.lit(3))), ""))
    return merge.trim_codons_with_protein(aa, nt, K, gaps=0.15)


@query("a28_dense_counts", "with c as (select l_returnflag as grp, l_linenumber as x, l_suppkey % 7 as y, count(*) as n from lineitem where l_quantity < 3 group by all), a as (select distinct grp, x from c), b as (select distinct grp, y from c) select grp, x, y, coalesce(n, 0) as n from a join b using (grp) left join c using (grp, x, y)")
def dense_counts(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem").where("l_quantity < 3")
    counts = items.groupBy(F.col("l_returnflag").alias("grp"), F.col("l_linenumber").alias("x"), (F.col("l_suppkey") % 7).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return merge.densify(counts, ["grp"], ["x", "y"])


@query("a29_file_statistics", f"with {ALIGNMENTS} select locus, case when locus like '%1' then 'AA' else 'NT' end as kind, count(*) as sequences, locus not like '%1' and locus like '%2' as coding from alignments group by 1")
def file_statistics(spark, sf_dir):
    # proteins hold a letter that nucleotides can't
    aa = F.col("locus").endswith("1")
    aln = views.alignments(spark, sf_dir).withColumn("sequence", F.when(aa, F.translate("sequence", "A", "E")).otherwise(F.col("sequence")))
    aln = aln.withColumn("sequence", F.when(aa, F.concat("sequence", F.lit("E"))).otherwise(F.col("sequence"))).withColumn("format", F.when(F.col("locus").endswith("2"), "NT").otherwise("GE"))
    return merge.file_statistics(aln, K).select("locus", "kind", "sequences", F.col("gc_codon_p1").isNotNull().alias("coding"))


_ENDS = f"{CONTIGS}, e as (select contig, upper(right(sequence, 60)) || upper(left(sequence, cast(15 + cast(contig as bigint) % 40 as bigint))) as trail, upper(left(sequence, cast(15 + cast(contig as bigint) % 40 as bigint))) || repeat('A', 30) as lead from contigs where length >= 120)"


@query("c29_overlaps", f"with {_ENDS}, t as (select contig, k, right(trail, k) as a, left(lead, k) as b from (select *, unnest(range(21, 1 + cast(least(length(trail), length(lead)) as bigint))) as k from e where least(length(trail), length(lead)) > 21)), m as (select contig, max(k) as overlap from t where list_sum([case when substr(a, i, 1) = substr(b, i, 1) then 1 else 0 end for i in range(1, k + 1)]) >= 0.9667 * k group by 1) select contig, cast(coalesce(overlap, 0) as int) as overlap from e left join m using (contig)")
def overlaps(spark, sf_dir):
    c = views.contigs(spark, sf_dir).where("length >= 120")
    head = F.substring(F.upper("sequence"), F.lit(1), (15 + F.col("contig").cast("long") % 40).cast("int"))
    return c.select("contig", stitch.overlap_length(F.concat(F.substring(F.upper("sequence"), F.length("sequence") - 59, F.lit(60)), head), F.concat(head, F.repeat(F.lit("A"), F.lit(30)))).alias("overlap"))


@query("q20_reference_candidates", f"with {CLUSTERS}, p as (select centroid, count(distinct sample) as samples, max(length) as longest, min(case when member = centroid then locus end) as locus from clusters group by 1), r as (select *, row_number() over (partition by locus order by samples desc, longest desc, centroid) as k from p where samples >= 4) select centroid, locus, samples from r where k = 1")
def reference_candidates(spark, sf_dir):
    return merge.reference_candidates(views.clusters(spark, sf_dir)).select("centroid", "locus", "samples")


_SMALL = "cl as (select vec_id - vec_id % 5 as centroid, vec_id as member, 100 + vec_id * 7 % 900 as length, 'L' || (vec_id // 5 % 9 + case when vec_id % 35 = 4 then 1 else 0 end) as locus from embeddings)"


@query("q19_target_set", f"with {_SMALL}, ld as (select centroid, locus as own, length as centroid_length from cl where member = centroid), m as (select centroid, own, centroid_length, max(case when locus <> own then 1 else 0 end) as mixed from cl join ld using (centroid) group by all), l as (select locus as own, max(length) as longest from cl group by 1) select centroid, own as locus, centroid_length, round(centroid_length / cast(longest as double), 4) as coverage from m join l using (own) where mixed = 0 and centroid_length >= 0.5 * longest")
def target_set(spark, sf_dir):
    v = F.col("vec_id")
    locus = F.concat(F.lit("L"), (F.floor(v / 5) % 9 + F.when(v % 35 == 4, 1).otherwise(0)).cast("string"))
    return merge.target_set(views.table(spark, sf_dir, "embeddings").select((v - v % 5).alias("centroid"), v.alias("member"), (100 + v * 7 % 900).alias("length"), locus.alias("locus")))


@query("q26_copied_loci", f"with {ALIGNMENTS} select locus, count(*) as rows from alignments where locus in (select locus from alignments where is_ref) group by 1")
def copied_loci(spark, sf_dir):
    aln = views.alignments(spark, sf_dir)
    return merge.copy_loci(aln, aln.where("is_ref"), dry=True)


@query("l06_shuffled_names", f"with {CONTIGS} select contig from contigs")
def shuffled_names(spark, sf_dir):
    return target_ops.shuffled(views.contigs(spark, sf_dir).select("contig"), "contig", 3)


@query("c26_contig_depth", f"with {CONTIGS} select sample, round(avg(depth), 6) as mean_depth from (select distinct sample, contig, depth from contigs) group by 1")
def contig_depth(spark, sf_dir):
    name = F.concat_ws("_", F.lit("NODE"), "contig", F.lit("cov"), F.col("depth").cast("string"))
    held = views.contigs(spark, sf_dir).groupBy("sample").agg(F.collect_list(name).alias("contigs"))
    return assembly.mean_contig_depth(held, ["sample"]).select("sample", F.round("mean_depth", 6).alias("mean_depth"))


@query("c11_n_count", f"with {ALIGNMENTS} select seq_name, cast(length(regexp_replace(sequence, '[^N]', '', 'g')) as int) as n_count, round(100.0 * length(regexp_replace(lower(left(sequence, 30)) || substr(sequence, 31), '[^a-z]', '', 'g')) / 120, 6) as low_complexity from alignments")
def n_count(spark, sf_dir):
    s = F.col("sequence")
    half = F.concat(F.lower(F.substring(s, 1, 30)), F.substring(s, 31, 1000))
    return views.alignments(spark, sf_dir).select("seq_name", seq.count_of(s, "N").alias("n_count"), F.round(seq.low_complexity_percent(half), 6).alias("low_complexity"))


@query("s08_exon_shares", "select p_partkey as cds_id, p_size as gene_len, coalesce(round(cast(p_partkey % 7 as double) / nullif(p_size - 1, 0), 6), 0) as prop_long_exons from part")
def exon_shares(spark, sf_dir):
    p = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cds_id"), F.col("p_size"), (F.col("p_size") - 1).alias("gene_len"), (F.col("p_partkey") % 7).alias("long_exons_len"), F.lit(0).alias("short_exons_len"))
    tables = _written(spark, p, "short_exons_len", [0], "cds_id long, p_size int, gene_len int, long_exons_len int, short_exons_len int")
    return readers.exon_shares(merge.merge_tables(tables)).select("cds_id", F.col("p_size").alias("gene_len"), F.round("prop_long_exons", 6).alias("prop_long_exons"))


@query("s09_quantification", f"with {CONTIGS} select contig, length, cast(depth * 10 as double) as num_reads from contigs")
def quantification(spark, sf_dir):
    path = shared_folder(spark, "quant")
    c = views.contigs(spark, sf_dir).select("contig", "length", (F.col("length") - 1).cast("double").alias("effective_length"), F.lit(1.5).alias("tpm"), (F.col("depth") * 10).alias("num_reads"))
    c.write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_quant(spark, path)


@query("s10_cluster_members", f"with {CLUSTERS} select distinct cast(centroid as varchar) as centroid, cast(member as varchar) as member from clusters")
def cluster_members(spark, sf_dir):
    path = shared_folder(spark, "members")
    c = views.clusters(spark, sf_dir).select("centroid", "member")
    c.union(c).write.option("sep", "\t").csv(path)
    return readers.read_clusters(spark, path)


@query("s13_external_assembly", f"with {CONTIGS} select contig as name, upper(sequence) as sequence from contigs where sequence <> '' and cast(contig as bigint) % 2 = 0")
def external_assembly(spark, sf_dir):
    c = views.contigs(spark, sf_dir).where("sequence <> ''")
    even = F.col("contig").cast("long") % 2 == 0
    rows = c.select(F.col("contig").alias("name"), F.when(even, F.translate(F.upper("sequence"), "T", "U")).otherwise(F.lit("MEEPQSDPSV")).alias("sequence"))
    return readers.import_assembly(rows)


@query("s14_ortholog_names", f"with {CONTIGS} select 'g' || contig || '_' || sample || '-' || 'g' || contig as name, sequence from contigs")
def ortholog_names(spark, sf_dir):
    c = views.contigs(spark, sf_dir).select(F.concat(F.lit("g"), "contig", F.lit("_"), "sample").alias("name"), "sequence")
    return readers.import_orthologs(c)


@query("s12_samples_of_files", f"with {CONTIGS} select distinct sample from contigs where sample not like '%\\_\\_%' escape '\\'")
def samples_of_files(spark, sf_dir):
    paths = views.contigs(spark, sf_dir).select(F.concat(F.lit("/x/"), "sample", F.lit("__ext/a.fasta")).alias("src_file")).distinct()
    return paths.select(readers.sample_of().alias("sample")).where("sample is not null")


@query("s04_annotated_files", "select distinct 'f' || s_nationkey as stem, '/d/f' || s_nationkey || '.fasta' as fasta, case when s_nationkey % 2 = 0 then '/g/f' || s_nationkey || '.gff3' end as gff from supplier")
def annotated_files(spark, sf_dir):
    n = views.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n")).distinct()
    of = lambda folder, end: F.concat(F.lit(folder), F.col("n").cast("string"), F.lit(end))
    return readers.match_annotations(n.select(of("/d/f", ".fasta").alias("path")), n.where("n % 2 = 0").select(of("/g/f", ".gff3").alias("path")))


@query("l02_best_only", f"with {ALIGNMENTS} select locus, seq_name from alignments where rank <= 0")
def best_only(spark, sf_dir):
    return target_ops.keep_ranks(views.alignments(spark, sf_dir), 0).select("locus", "seq_name")


@query("q27_site_totals", f"with {ALIGNMENTS}, n as (select locus, count(*) as rows from alignments group by 1) select locus, rows, rows * 120 as residues from n")
def site_totals(spark, sf_dir):
    counts = sites.site_counts(views.alignments(spark, sf_dir), K)
    per = counts.groupBy("locus", "pos").agg(F.sum("n").alias("n")).groupBy("locus").agg(F.max("n").alias("rows"), F.sum("n").alias("residues"))
    return per
