"""Queries over similarity hits and extraction statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from phylospark.operators import hits as ops

from . import views
from .registry import query
from .views import CONTIGS, EXTRACTION, HITS

K = ["sample", "locus"]
_REGION0 = "case when q_end - q_start >= q_size * 0.9 or (q_start < q_size * 0.1 and q_size - q_end < q_size * 0.1) then 'full' when q_start >= q_size * 0.1 and q_size - q_end >= q_size * 0.1 then 'middle' when q_start <= q_size * 0.1 then 'proximal' when q_size - q_end <= q_size * 0.1 then 'distal' else 'wedged' end"
_REGION = f"""{HITS}, r0 as (select *, {_REGION0} as r, t_start / cast(nullif(t_end - t_start, 0) as double) < 0.1 as lf, (t_size - t_end) / cast(nullif(t_end - t_start, 0) as double) < 0.1 as rf from hits),
  regions as (select * exclude (r, lf, rf), case when r = 'middle' and (lf or rf) or ((r = 'proximal' and strand = '+') or (r = 'distal' and strand = '-')) and rf or ((r = 'proximal' and strand = '-') or (r = 'distal' and strand = '+')) and lf then 'wedged' else r end as region from r0)"""


def _hits(spark, sf_dir):
    return views.hits(spark, sf_dir)


def _region(h):
    return h.withColumn("region", ops.hit_region(*[F.col(c) for c in ("q_size", "q_start", "q_end", "t_size", "t_start", "t_end", "strand")]))


@query("c17_hit_identity", f"with {HITS} select hit_id, round(case when least(q_end - q_start, t_end - t_start) <= 0 then 0 else 100 - 0.1 * case when matches + mismatches <> 0 then 1000.0 * (mismatches + q_num_insert + floor(3 * ln(1 + abs((q_end - q_start) - (t_end - t_start))) + 0.5)) / (matches + mismatches) else 0 end end, 6) as identity from hits")
def hit_identity(spark, sf_dir):
    c = F.col
    return _hits(spark, sf_dir).select("hit_id", F.round(ops.hit_identity(c("matches"), c("mismatches"), c("q_num_insert"), c("q_end") - c("q_start"), c("t_end") - c("t_start")), 6).alias("identity"))


@query("c18_prefilter_score", f"with {HITS} select hit_id, round((matches - mismatches - q_num_insert) / cast(q_size as double) * ((matches + mismatches) / cast(q_size as double)), 6) as score from hits")
def prefilter_score(spark, sf_dir):
    c = F.col
    return _hits(spark, sf_dir).select("hit_id", F.round(ops.prefilter_score(c("matches"), c("mismatches"), c("q_num_insert"), c("q_size")), 6).alias("score"))


@query("c19_weighted_score", f"with {HITS} select hit_id, round(pow(identity / 100, 2) * sqrt(coverage / 100) * pow(0.999, q_num_insert) * pow(0.975, hit_id % 3), 6) as score from hits")
def weighted_score(spark, sf_dir):
    c = F.col
    return _hits(spark, sf_dir).select("hit_id", F.round(ops.weighted_score(c("identity"), c("coverage"), c("q_num_insert") + 1, c("hit_id") % 3), 6).alias("score"))


@query("c20_hit_region", f"with {_REGION} select hit_id, region from regions")
def hit_region(spark, sf_dir):
    return _region(_hits(spark, sf_dir)).select("hit_id", "region")


@query("p19_region_gate", f"with {_REGION} select hit_id from regions where not (coverage < 10 and region = 'wedged')")
def region_gate(spark, sf_dir):
    return ops.region_gate(_region(_hits(spark, sf_dir))).select("hit_id")


@query("p06_score_gate", f"with {HITS} select hit_id from hits where wscore >= 0.13 and identity >= 65 and coverage >= 20")
def score_gate(spark, sf_dir):
    return ops.score_gate(_hits(spark, sf_dir)).select("hit_id")


@query("w12_weak_targets", f"with {HITS}, b as (select *, max(wscore) over (partition by sample, locus, target) as best from hits) select hit_id from b where wscore >= greatest(0.001, 0.5 * best)")
def weak_targets(spark, sf_dir):
    return ops.drop_weak_targets(_hits(spark, sf_dir), K, share=0.5).select("hit_id")


@query("l01_top_targets", f"with {HITS}, b as (select locus, target, row_number() over (partition by locus order by max(wscore) desc, target) as r from hits group by 1, 2) select hit_id from hits join b using (locus, target) where r <= 7")
def top_targets(spark, sf_dir):
    return ops.top_targets(_hits(spark, sf_dir), ["locus"], 7).select("hit_id")


_BUDGET = f"""{HITS}, g as (select sample, count(distinct locus || '_' || target) as t, count(distinct locus) as loci, max(t_size) as largest from hits group by 1), tg as (select sample, locus, target, row_number() over (partition by sample, locus order by max(wscore) desc, target) as r from hits group by 1, 2, 3),
    ns as (select g.sample, s.stage, s.budget, s.chromosome, t, loci, case when largest >= s.chromosome then 3 else 7 end as small, case when largest >= s.chromosome then 10 else 100 end as most from g, (values ('first', 400000000, 12000), ('first', 2000, 20000), ('final', 400000000, 20000), ('final', 40000, 20000), ('final', 100, 12000)) as s(stage, budget, chromosome)),
    nb as (select *, case when stage = 'final' and t * (t - 1) <= budget then 1000000 when stage = 'first' and t * (t - 1) < budget then small else (select coalesce(max(n), 1) from range(2, 101) as x(n) where n <= most and loci * (loci - 1) * n * n <= budget) end as best_n from ns)
    select stage, cast(budget as bigint) as budget, hit_id from hits join tg using (sample, locus, target) join nb using (sample) where r <= best_n"""


@query("l01_budgeted_targets", f"with {_BUDGET}")
def budgeted_targets(spark, sf_dir):
    """Both rounds, with and without chromosomes, within the budget and over it."""
    h = _hits(spark, sf_dir)
    out = None
    for first, budget, chromosome in ((True, 400_000_000, 12_000), (True, 2000, 20_000), (False, 400_000_000, 20_000), (False, 40_000, 20_000), (False, 100, 12_000)):
        rows = ops.budgeted_targets(h, ["sample"], first, budget, chromosome).select(F.lit("first" if first else "final").alias("stage"), F.lit(budget).cast("long").alias("budget"), "hit_id")
        out = rows if out is None else out.union(rows)
    return out


@query(
    "j05_drop_overlaps",
    f"""with {HITS} select hit_id from hits h where not exists (select 1 from hits b where b.sample = h.sample and b.contig = h.contig
      and row(-b.wscore, b.target, b.t_start, b.q_start, b.hit_id) < row(-h.wscore, h.target, h.t_start, h.q_start, h.hit_id) and (b.locus <> h.locus or b.target = h.target)
      and (least(h.t_end, b.t_end) - greatest(h.t_start, b.t_start)) * 100.0 > 5.0 * greatest(h.t_end - h.t_start, b.t_end - b.t_start))""",
)
def drop_overlaps(spark, sf_dir):
    return ops.drop_overlaps(_hits(spark, sf_dir), width=2000).select("hit_id")


@query("w01_paralog_rank", f"with {HITS} select hit_id, lpad(cast(row_number() over (partition by sample, locus order by wscore desc, hit_id) - 1 as varchar), 2, '0') as hit from hits")
def paralog_rank(spark, sf_dir):
    return ops.ranked(_hits(spark, sf_dir), K).select("hit_id", "hit")


@query("w03_locus_coverage", f"with {HITS} select hit_id, round(100.0 * (q_end - q_start) / max(q_end - q_start) over (partition by sample, locus), 4) as locus_coverage from hits")
def locus_coverage(spark, sf_dir):
    return ops.locus_coverage(_hits(spark, sf_dir), K).select("hit_id", "locus_coverage")


@query(
    "w04_paralog_tolerance",
    f"""with {HITS}, b as (select *, first_value(identity) over w as bi, first_value(coverage) over w as bc, first_value(depth) over w as bd from hits window w as (partition by sample, locus order by wscore desc, hit_id)),
    k as (select *, row_number() over (partition by sample, locus order by wscore desc, hit_id) as n from b where identity >= 0.66 * bi and coverage >= 0.33 * bc and depth >= 0.33 * bd) select hit_id from k where n <= 3""",
)
def paralog_tolerance(spark, sf_dir):
    return ops.tolerated_paralogs(_hits(spark, sf_dir), K, max_paralogs=2).select("hit_id")


@query(
    "w06_depth_floor",
    f"""with {HITS}, b as (select sample, locus, depth as d from (select *, row_number() over (partition by sample, locus order by wscore * log10(depth) desc, depth desc) as n from hits) where n = 1),
    f as (select *, case when d > 1 then pow(10.0, round(log10(d) * 0.5, 2)) else 0 end as least from b) select hit_id from hits join f using (sample, locus) where depth >= least""",
)
def depth_floor(spark, sf_dir):
    return ops.depth_floor(_hits(spark, sf_dir), K).select("hit_id")


@query("w11_best_target", f"with {HITS}, p as (select sample, locus, target, max(wscore) as best, round(avg(wscore), 9) as mean from hits group by 1, 2, 3), r as (select *, row_number() over (partition by sample, locus order by best desc, mean desc, target) as n from p) select sample, locus, target, best, mean from r where n = 1")
def best_target(spark, sf_dir):
    return ops.best_target(_hits(spark, sf_dir), K)


@query("j01_hit_sequences", f"with {HITS}, {CONTIGS} select hit_id, substr(sequence, t_start + 1, t_end - t_start) as matched from hits join contigs c on cast(c.contig as bigint) = hits.contig where t_end <= c.length")
def hit_sequences(spark, sf_dir):
    c = views.contigs(spark, sf_dir).select(F.col("contig").cast("long").alias("contig"), "sequence", "length")
    out = _hits(spark, sf_dir).join(c, "contig").where("t_end <= length")
    return out.select("hit_id", F.substring(F.col("sequence"), (F.col("t_start") + 1).cast("int"), (F.col("t_end") - F.col("t_start")).cast("int")).alias("matched"))


@query("c22_coordinates", f"with {HITS} select sample, contig, string_agg((t_start + 1) || '-' || t_end, ',' order by t_start, t_end) as coordinates from hits group by 1, 2")
def coordinates(spark, sf_dir):
    blocks = F.array_sort(F.collect_list(F.struct(F.col("t_start").alias("s"), F.col("t_end").alias("e"))))
    return _hits(spark, sf_dir).groupBy("sample", "contig").agg(blocks.alias("blocks")).select("sample", "contig", ops.format_coordinates(F.col("blocks")).alias("coordinates"))


@query("c21_merged_blocks", f"with {HITS}, o as (select *, lag(t_end) over w as before from hits window w as (partition by sample, contig order by t_start, t_end)), g as (select *, sum(case when before is null or t_start - before >= 200 then 1 else 0 end) over (partition by sample, contig order by t_start, t_end rows unbounded preceding) as k from o) select sample, contig, string_agg(a || '-' || b, ',' order by k) as blocks from (select sample, contig, k, arg_min(t_start, row(t_start, t_end)) + 1 as a, arg_max(t_end, row(t_start, t_end)) as b from g group by 1, 2, 3) group by 1, 2")
def merged_blocks(spark, sf_dir):
    pairs = F.array_sort(F.collect_list(F.struct(F.col("t_start").cast("int").alias("s"), F.col("t_end").cast("int").alias("e"))))
    rows = _hits(spark, sf_dir).groupBy("sample", "contig").agg(pairs.alias("p"))
    starts, sizes = F.transform("p", lambda x: x.s), F.transform("p", lambda x: x.e - x.s)
    return rows.select("sample", "contig", ops.format_coordinates(ops.merge_blocks(sizes, starts, F.lit(200))).alias("blocks"))


@query("c24_hit_overlap", f"with {HITS} select a.hit_id, b.hit_id as other, greatest(0, least(a.t_end, b.t_end) - greatest(a.t_start, b.t_start)) as shared from hits a join hits b on a.sample = b.sample and a.contig = b.contig and a.hit_id < b.hit_id and a.locus = b.locus")
def hit_overlap(spark, sf_dir):
    h = _hits(spark, sf_dir).select("sample", "contig", "locus", "hit_id", F.array(F.struct(F.col("t_start").alias("s"), F.col("t_end").alias("e"))).alias("blocks"))
    other = h.select("sample", "contig", "locus", F.col("hit_id").alias("other"), F.col("blocks").alias("b2"))
    met = h.join(other, ["sample", "contig", "locus"]).where("hit_id < other")
    return met.select("hit_id", "other", ops.overlap(F.col("blocks"), F.col("b2")).alias("shared"))


@query("c27_fragmentation", f"""with {HITS}, b as (select sample, locus, contig, sum(t_end - t_start) as len from hits group by 1, 2, 3), r as (select *, sum(len) over w as upto, row_number() over w as n, sum(len) over (partition by sample, locus) as total from b window w as (partition by sample, locus order by len desc, contig rows unbounded preceding))
    select sample, locus, max(len) filter (where upto >= total * 0.5) as n50, min(n) filter (where upto >= total * 0.5) as l50, max(len) filter (where upto >= total * 0.9) as n90, min(n) filter (where upto >= total * 0.9) as l90 from r group by 1, 2""")
def fragmentation(spark, sf_dir):
    from phylospark.operators.assembly import nx_lx

    blocks = _hits(spark, sf_dir).groupBy(*K, "contig").agg(F.sum(F.col("t_end") - F.col("t_start")).alias("length"))
    return nx_lx(blocks, K, (0.5, 0.9))


@query("k06_gff_lines", f"with {HITS} select sample, contig || chr(9) || 'phylospark' || chr(9) || 'match' || chr(9) || (t_start + 1) || chr(9) || t_end || chr(9) || printf('%.2f', identity) || chr(9) || strand || chr(9) || '.' || chr(9) || 'ID=' || hit_id || ';Name=' || locus || '%20' || target || ';WScore=' || printf('%.5f', wscore) as line from hits")
def gff_lines(spark, sf_dir):
    return ops.gff_lines(_hits(spark, sf_dir))


def _ext(spark, sf_dir):
    return views.extraction(spark, sf_dir)


_PSL = """it as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as line from lineitem), bl as (select l_orderkey as id, line, cast(l_quantity as bigint) as n, coalesce(sum(cast(l_quantity as bigint) + l_partkey % 300) over w, 0) as t, coalesce(sum(cast(l_quantity as bigint) + l_suppkey % 5) over w, 0) as q
    from it window w as (partition by l_orderkey order by line rows between unbounded preceding and 1 preceding)), sz as (select *, max(q + n) over (partition by id) + 10 as q_size from bl)"""


@query(
    "c21_psl_blocks",
    f"""with {_PSL}, gp as (select *, t - lag(t + n) over (partition by id order by line) as gap from sz), isl as (select *, sum(case when gap is null or gap >= least(q_size * 0.2, 200) then 1 else 0 end) over (partition by id order by line) as k from gp),
    jn as (select id, k, max(q_size) as z, min(q) as qs, max(q + n) as qe, min(t) as ts, max(t + n) as te from isl group by 1, 2)
    select id, case when id % 2 = 0 then string_agg((qs + 1) || '-' || qe, ',' order by k) else string_agg((z - qe + 1) || '-' || (z - qs), ',' order by k desc) end as q, string_agg((ts + 1) || '-' || te, ',' order by k) as t from jn group by id""",
)
def psl_blocks(spark, sf_dir):
    """Line items of an order as the blocks of a record, odd orders on the minus strand."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").rowsBetween(Window.unboundedPreceding, -1)
    n = F.col("l_quantity").cast("long")
    place = lambda c: F.coalesce(F.sum(n + c).over(w), F.lit(0))
    own = views.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), place(F.col("l_suppkey") % 5).alias("q"), place(F.col("l_partkey") % 300).alias("t"), n.alias("n"))
    rows = own.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("t", "q", "n"))).alias("x"), (F.max(F.col("q") + F.col("n")) + 10).alias("q_size"))
    found = ops.psl_blocks(F.col("x.n"), F.col("x.q"), F.col("x.t"), F.col("q_size"), F.when(F.col("id") % 2 == 0, "+").otherwise("-"))
    return rows.select("id", found.alias("b")).select("id", ops.format_coordinates(F.col("b.q")).alias("q"), ops.format_coordinates(F.col("b.t")).alias("t"))


@query("a20_recovery", f"with {EXTRACTION}, r as (select *, row_number() over (partition by sample, locus order by wscore desc, hit_id) as n from extraction), s as (select sample, count(distinct locus) as loci, count(*) filter (where n > 1) as paralogs, cast(count(*) filter (where n = 1) as bigint) as m, cast(sum(ref_len_matched) filter (where n = 1) as bigint) as total_best_length, cast(sum(cast(round(coverage * 100) as bigint)) filter (where n = 1) as bigint) as hundredths from r group by 1) select sample, loci, paralogs, cast((20000 * total_best_length + m) // (2 * m) as double) / 10000 as mean_best_length, total_best_length, cast((200 * hundredths + m) // (2 * m) as double) / 10000 as mean_best_coverage from s")
def recovery(spark, sf_dir):
    return ops.recovery_summary(ops.ranked(_ext(spark, sf_dir), K), ["sample"])


_BEST = f"{EXTRACTION}, best as (select sample, marker, locus, wscore, coverage, hits, n_frameshifts from (select *, count(*) over (partition by sample, marker, locus) as hits, case when frameshifts is null then 0 else length(frameshifts) - length(replace(frameshifts, ',', '')) + 1 end as n_frameshifts, row_number() over (partition by sample, marker, locus order by wscore desc, hit_id) as n from extraction) where n = 1)"


@query("a21_best_hits", f"with {_BEST} select * from best")
def best_hits(spark, sf_dir):
    return ops.best_hit_report(_ext(spark, sf_dir))


@query("a21_loci_by_level", f"with {_BEST} select sample, marker, count(distinct locus) as loci from (select sample, marker, locus from best union all select sample, 'ALL', locus from best) group by 1, 2")
def loci_by_level(spark, sf_dir):
    return ops.loci_by_level(ops.best_hit_report(_ext(spark, sf_dir)))


@query("c28_frameshifts", f"with {CONTIGS} select contig, array_to_string(list_sort(list_distinct([(i + 2) // 3 for i in range(1, length + 1) if substr(sequence, i, 1) = 'g'])), ',') as codons from contigs")
def frameshifts(spark, sf_dir):
    c = views.contigs(spark, sf_dir).select("contig", F.translate("sequence", "g", "N").alias("s"))
    return c.select("contig", F.when(F.length("s") > 0, ops.frameshift_positions(F.col("s"))).otherwise("").alias("codons"))
