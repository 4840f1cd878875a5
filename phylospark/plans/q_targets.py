"""Queries over clusters, loci, targets and baits."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.operators import hits as hit_ops
from phylospark.operators import targets as ops

from . import views
from .registry import query
from .views import ALIGNMENTS, CLUSTERS, CONTIGS, EXTRACTION, LOCUS_STATS


def _clusters(spark, sf_dir):
    return views.clusters(spark, sf_dir)


@query("p02_split_names", f"with {ALIGNMENTS} select seq_name, sample, cast(case when is_ref then 0 else rank end as int) as rank, is_ref from alignments")
def split_names(spark, sf_dir):
    a = views.alignments(spark, sf_dir)
    name = F.when(F.col("is_ref"), F.concat_ws("__", "sample", F.lit("ref"))).when(F.col("rank") > 0, F.concat_ws("__", "sample", F.format_string("%02d", "rank"))).otherwise(F.col("sample"))
    return ops.split_names(a.select("seq_name", name.alias("name"))).select("seq_name", "sample", "rank", "is_ref")


@query("p03_sanitised", "select p_partkey, translate(p_name || ':(' || p_type || ')', ':()', '___') as name from part")
def sanitised(spark, sf_dir):
    return views.table(spark, sf_dir, "part").select("p_partkey", ops.sanitise(F.concat("p_name", F.lit(":("), "p_type", F.lit(")"))).alias("name"))


@query("p05_tags", f"with {EXTRACTION} select hit_id, target, cast(coverage as varchar) as cover from extraction")
def tags(spark, sf_dir):
    d = F.concat(F.lit("[target="), "target", F.lit("] [cover="), F.col("coverage").cast("string"), F.lit("]"))
    return views.extraction(spark, sf_dir).select("hit_id", ops.tag(d, "target").alias("target"), ops.tag(d, "cover").alias("cover"))


@query("a14_cluster_occupancy", f"with {CLUSTERS} select centroid, count(distinct sample) as samples, count(distinct species) as species, count(*) as members from clusters group by 1 having count(distinct species) >= 3 and count(*) > 1")
def cluster_occupancy(spark, sf_dir):
    return ops.cluster_occupancy(_clusters(spark, sf_dir), 3)


_COPIES = f"{CLUSTERS}, per as (select centroid, sample, count(*) as c, max(length) as top, max(length) filter (where member = centroid) as own from clusters group by 1, 2), cc as (select centroid, count(*) as samples, cast(sum(c) as bigint) as sequences, median(c) as median_copies, max(top) as longest, max(own) as centroid_length from per group by 1)"


@query("a26_cluster_copies", f"with {_COPIES} select * from cc")
def cluster_copies(spark, sf_dir):
    return ops.cluster_copies(_clusters(spark, sf_dir))


@query("a15_selected_clusters", f"with {_COPIES} select * from cc where samples >= 3 and median_copies <= 1.5 and centroid_length >= 300")
def selected_clusters(spark, sf_dir):
    return ops.select_clusters(_clusters(spark, sf_dir), 3, 1.5, 300)


@query("a16_summary", f"with {_COPIES} select measure, median(v) as median, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as sd, min(v) as least, max(v) as largest from (select 'samples' as measure, cast(samples as double) as v from cc union all select 'sequences', cast(sequences as double) from cc union all select 'longest', cast(longest as double) from cc) group by 1")
def cluster_summary(spark, sf_dir):
    return ops.summary(ops.cluster_copies(_clusters(spark, sf_dir)), ["samples", "sequences", "longest"])


@query("j04_cluster_members", f"with {CLUSTERS} select centroid, member, e.label from clusters join embeddings e on e.vec_id = member")
def cluster_members(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("member"), "label")
    return _clusters(spark, sf_dir).select("centroid", "member").join(e, "member")


@query("j09_inclusions", f"with {CLUSTERS}, lead as (select centroid, locus as own from clusters where member = centroid), met as (select * from clusters join lead using (centroid) where locus <> own), a as (select own as locus, string_agg(distinct locus, ',' order by locus) as includes from met group by 1), b as (select locus, string_agg(distinct own, ',' order by own) as included_in from met group by 1) select locus, includes, included_in from a full join b using (locus)")
def inclusions(spark, sf_dir):
    return ops.inclusions(_clusters(spark, sf_dir))


_REPS = f"{_COPIES}, named as (select cc.*, c.locus from cc join clusters c on c.centroid = cc.centroid and c.member = c.centroid), rk as (select *, row_number() over w as rank, first_value(centroid_length) over w as tl, first_value(sequences) over w as ts from named window w as (partition by locus order by samples desc, centroid_length desc, centroid)), reps as (select locus, centroid, rank, samples, centroid_length from rk where rank = 1 or centroid_length >= 0.75 * tl and sequences >= 0.3333 * ts)"


@query("w10_representatives", f"with {_REPS} select * from reps")
def representatives(spark, sf_dir):
    return ops.representatives(_clusters(spark, sf_dir), ["locus"])


_SPLIT = f"{_REPS}, sh as (select *, samples / cast(max(samples) over (partition by locus) as double) >= 0.6666 as well, count(*) over (partition by locus) as k from reps), split as (select *, case when k = 1 then locus when well then locus || '.PAR' || cast(sum(well::int) over (partition by locus order by rank) as bigint) else locus || '.PMIN' end as name from sh)"


@query("q22_split_paralogs", f"with {_SPLIT} select locus, centroid, rank, samples, centroid_length, name from split")
def split_paralogs(spark, sf_dir):
    return ops.split_paralogs(ops.representatives(_clusters(spark, sf_dir), ["locus"]), ["locus"])


@query("j14_funnel", f"with {_SPLIT}, raw as (select locus, count(distinct sample) as raw_samples from clusters group by 1), fil as (select locus, count(distinct sample) as filtered_samples from clusters where length >= 400 group by 1), fin as (select regexp_replace(name, '\\.(PAR[0-9]+|PMIN)$', '') as locus, max(samples) as final_samples, max(regexp_matches(name, '\\.(PAR[0-9]+|PMIN)$')) as split, count(*) as targets from split group by 1) select locus, raw_samples, filtered_samples, final_samples, fin.split as split, targets, round(100.0 * coalesce(filtered_samples, 0) / raw_samples, 4) as pct_retained from raw left join fil using (locus) left join fin using (locus)")
def funnel(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    raw = c.groupBy("locus").agg(F.count_distinct("sample").alias("raw_samples"))
    kept = c.where("length >= 400").groupBy("locus").agg(F.count_distinct("sample").alias("filtered_samples"))
    return ops.funnel(raw, kept, ops.split_paralogs(ops.representatives(c, ["locus"]), ["locus"]))


@query("q25_long_short", f"with {CLUSTERS} select locus, member, case when length > 0.5 * max(length) over (partition by locus) then 'long' else 'short' end as part from clusters")
def long_short(spark, sf_dir):
    return ops.long_and_short(_clusters(spark, sf_dir), ["locus"]).select("locus", "member", "part")


@query("q21_prefilter", f"with {CLUSTERS}, m as (select *, median(length) over (partition by locus) as med from clusters) select member from m where length >= 99 and length >= 0.3333 * med")
def prefilter(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    med = c.groupBy("locus").agg(F.expr("percentile(length, 0.5)").alias("med"))
    return c.join(med, "locus").where((F.col("length") >= 99) & (F.col("length") >= 0.3333 * F.col("med"))).select("member")


_RANKED = f"{EXTRACTION}, ranked as (select *, row_number() over (partition by sample, locus order by wscore desc, hit_id) as n from extraction), votes as (select locus, target, count(*) as n from ranked where n = 1 group by 1, 2)"


@query("a18_common_target", f"with {_RANKED} select locus, arg_min(target, row(-n, target)) as target, max(n) as votes, cast(sum(n) as bigint) as samples from votes group by 1 having sum(n) >= 4")
def common_target(spark, sf_dir):
    return ops.most_common_target(hit_ops.ranked(views.extraction(spark, sf_dir), ["sample", "locus"]))


@query("j17_chosen_targets", f"with {_RANKED}, ch as (select locus, arg_min(target, row(-n, target)) as target from votes group by 1 having sum(n) >= 4), t as (select distinct 't' || (c_custkey % 10) as target from customer) select ch.locus, ch.target, t.target is null as missing from ch left join t using (target)")
def chosen_targets(spark, sf_dir):
    chosen = ops.most_common_target(hit_ops.ranked(views.extraction(spark, sf_dir), ["sample", "locus"]))
    known = views.table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), (F.col("c_custkey") % 10).cast("string")).alias("target"), F.lit(True).alias("known")).distinct()
    return chosen.join(known, "target", "left").select("locus", "target", F.col("known").isNull().alias("missing"))


@query("j15_targets_and_contigs", f"with {EXTRACTION} select distinct sample, target from extraction where locus in (select locus from extraction where wscore > 0.8)")
def targets_and_contigs(spark, sf_dir):
    e = views.extraction(spark, sf_dir)
    return e.join(e.where("wscore > 0.8").select("locus"), "locus", "left_semi").select("sample", "target").distinct()


_RANGES = {"sequences": (1, None), "length": (5, 200), "gc": (20.0, 80.0), "mean_pid": (10.0, None), "missingness": (None, 90.0), "informative": (3, None), "avg_copies": (1, 3.5), "len_long_exons_retained": (10, None), "perc_exons_retained": (15.0, None)}
_NULLS = ("len_long_exons_retained", "perc_exons_retained")
_CONDS = [("sequences >= 1"), ("length between 5 and 200"), ("gc between 20 and 80"), ("mean_pid >= 10"), ("missingness <= 90"), ("informative >= 3"), ("avg_copies between 1 and 3.5"), ("coalesce(len_long_exons_retained >= 10, true)"), ("coalesce(perc_exons_retained >= 15, true)")]


@query("p09_selected_loci", f"with {LOCUS_STATS} select locus, length, gc from locus_stats where {' and '.join(_CONDS)}")
def selected_loci(spark, sf_dir):
    return ops.select_loci(views.locus_stats(spark, sf_dir), _RANGES, _NULLS).select("locus", "length", "gc")


@query("p09_selection_funnel", f"with {LOCUS_STATS} select " + ", ".join(f"count(*) filter (where {' and '.join(_CONDS[: i + 1])}) as after_{c}" for i, c in enumerate(_RANGES)) + f", cast(sum(coalesce(len_long_exons_retained, length)) filter (where {' and '.join(_CONDS)}) as bigint) as footprint from locus_stats")
def selection_funnel(spark, sf_dir):
    return ops.selection_funnel(views.locus_stats(spark, sf_dir), _RANGES, _NULLS)


@query("a24_histogram", f"with {LOCUS_STATS} select cast(floor((gc - 0.0) / 5.0) + 1 as bigint) as bin, count(*) as n from locus_stats group by 1")
def histogram(spark, sf_dir):
    return ops.equal_width_histogram(views.locus_stats(spark, sf_dir), "gc", 0, 100, 20)


@query("a25_outlier_cap", f"with {EXTRACTION} select marker, round(quantile_cont(coverage, 0.75) + 3 * (quantile_cont(coverage, 0.75) - quantile_cont(coverage, 0.25)), 6) as cap from extraction group by 1")
def outlier_cap(spark, sf_dir):
    return ops.upper_whisker(views.extraction(spark, sf_dir), ["marker"], "coverage")


@query("c30_min_max", f"with {LOCUS_STATS} select locus, round((gc - (select min(gc) from locus_stats)) / ((select max(gc) from locus_stats) - (select min(gc) from locus_stats)), 6) as scaled from locus_stats")
def min_max(spark, sf_dir):
    return ops.min_max(views.locus_stats(spark, sf_dir), "gc").select("locus", F.round("scaled", 6).alias("scaled"))


@query("p14_reference_info", f"with {CONTIGS}, t as (select sample as locus, avg(length) as m from contigs group by 1) select true as all_named, count(*) as loci, round(sum(m), 4) as total_length from t")
def reference_info(spark, sf_dir):
    c = views.contigs(spark, sf_dir).select(F.concat_ws("-", "contig", "sample").alias("target"), "sequence")
    return ops.reference_info(c)


@query("p07_shred", f"""with {CONTIGS}, p as (select contig, sequence, length as n, cast(ceil(length / 700.0) as bigint) as k from contigs where length > 0), q as (select *, n // k as size, n - n // k * k as rest, unnest(range(0, k)) as i from p),
    r as (select *, i * size + least(i, rest) + 1 as a, least((i + 1) * size + least(i + 1, rest), n) as b from q) select case when n > 700 then contig || '_' || a || '_' || b else contig end as name, substr(sequence, a, b - a + 1) as sequence from r""")
def shredded(spark, sf_dir):
    return ops.shred(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), 700)


_TILES = f"{CONTIGS}, tiles as (select contig as name, (i - 1) // 40 + 1 as bait_no, sample, substr(s, i, 120) as bait from (select *, unnest(range(1, length(s) - 118, 40)) as i from (select contig, sample, upper(sequence) as s from contigs where length >= 120)))"


def _tiles(spark, sf_dir):
    return ops.tile(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), step=40)


@query("q13_tiling", f"with {_TILES} select name, cast(bait_no as int) as bait_no, bait from tiles")
def tiling(spark, sf_dir):
    return _tiles(spark, sf_dir)


@query("q14_dereplicated", f"with {_TILES}, c as (select *, least(bait, translate(reverse(bait), 'ACGT', 'TGCA')) as canonical from tiles) select arg_min(name, row(name, bait_no)) as name, cast(arg_min(bait_no, row(name, bait_no)) as int) as bait_no, arg_min(bait, row(name, bait_no)) as bait, count(*) as copies from c group by canonical")
def dereplicated(spark, sf_dir):
    return ops.dereplicate(_tiles(spark, sf_dir))


@query("u04_distinct_baits", f"with {_TILES} select substr(name, 1, 1) as locus, bait, max(name) as name, cast(arg_max(bait_no, row(name, bait_no)) as int) as bait_no from tiles group by 1, 2")
def distinct_baits(spark, sf_dir):
    return ops.distinct_in_locus(_tiles(spark, sf_dir).withColumn("locus", F.substring("name", 1, 1)), ["locus"])


_RUNS = "case when len({0}) > 1 then greatest(1, list_max([length(x) for x in list_slice({0}, 1, len({0}) - 1)])) else 1 end"
_HOMO = _RUNS.format("regexp_extract_all(bait, 'A+|C+|G+|T+')")
_BAITS = f"{_TILES}, st as (select name, bait_no, round(100.0 * length(regexp_replace(bait, '[^GC]', '', 'g')) / 120.0, 2) as gc, cast({_HOMO} as int) as max_homopolymer_len from tiles), ms as (select *, 79.8 + 58.4 * (gc / 100.0) + 11.8 * (gc / 100.0) * (gc / 100.0) - 820.0 / 120 + 18.5 * ln(0.9) as melt_temp from st)"


@query("p10_filtered_baits", f"with {_BAITS} select name, cast(bait_no as int) as bait_no, gc, round(cast(melt_temp as double), 6) as melt_temp, max_homopolymer_len, gc between 30 and 50 and melt_temp between 0 and 120 and max_homopolymer_len <= 6 as accepted from ms")
def filtered_baits(spark, sf_dir):
    return ops.filter_baits(_tiles(spark, sf_dir)).select("name", "bait_no", "gc", F.round("melt_temp", 6).alias("melt_temp"), "max_homopolymer_len", "accepted")


_CANON = "least(k, translate(reverse(k), 'ACGT', 'TGCA'))"


@query("q16_excluded_baits", f"with {_TILES}, ref as (select distinct {_CANON} as kmer from (select substr(s, i, 31) as k from (select *, unnest(range(1, length(s) - 29)) as i from (select upper(sequence) as s from contigs where length >= 31 and sample = 'src0')))), own as (select name, bait_no, {_CANON} as kmer from (select name, bait_no, substr(bait, i, 31) as k from (select *, unnest(range(1, 91)) as i from tiles))) select name, cast(bait_no as int) as bait_no, bait from tiles where (name, bait_no) not in (select (name, bait_no) from own join ref using (kmer))")
def excluded_baits(spark, sf_dir):
    ref = views.contigs(spark, sf_dir).where("length >= 31 and sample = 'src0'")
    return ops.exclude_matches(_tiles(spark, sf_dir), ref).select("name", "bait_no", "bait")


@query("a19_bait_table", f"with {_TILES}, b as (select 'L' || (cast(name as bigint) % 60) as locus, count(*) as baits from tiles group by 1), t as (select 'L' || (vec_id % 90) as locus, count(*) as targets, max(100 + vec_id * 7 % 900) as longest from embeddings group by 1), j as (select locus, coalesce(baits, 0) as baits, coalesce(targets, 0) as targets, longest, round(coalesce(coalesce(baits, 0) * 120 / cast(longest as double), 0), 4) as tiling from t full join b using (locus)) select *, concat_ws(',', case when baits = 0 then 'no baits' end, case when targets = 0 then 'no targets' end, case when baits > 0 and tiling < 1 then 'low tiling' end) as removed from j")
def bait_table(spark, sf_dir):
    baits = _tiles(spark, sf_dir).select(F.concat(F.lit("L"), (F.col("name").cast("long") % 60).cast("string")).alias("locus"))
    targets = views.table(spark, sf_dir, "embeddings").select(F.concat(F.lit("L"), (F.col("vec_id") % 90).cast("string")).alias("locus"), (100 + F.col("vec_id") * 7 % 900).alias("length"))
    return ops.bait_table(baits, targets)


@query("l05_numbered_loci", f"with {CLUSTERS} select centroid, member, lpad(cast(dense_rank() over (order by centroid) as varchar), 6, '0') as locus_no from clusters")
def numbered_loci(spark, sf_dir):
    return ops.number_loci(_clusters(spark, sf_dir).select("centroid", "member"), "centroid")
