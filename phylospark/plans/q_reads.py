"""Queries over reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.operators import reads as ops

from . import views
from .registry import query
from .views import READS

_Q = "[ascii(substr(quality, i, 1)) - 33 for i in range(1, length(quality) + 1)]"
_FLAT = f"{READS}, flat as (select sample, mate, read_id, i - 1 as pos, substr(sequence, i, 1) as base, ascii(substr(quality, i, 1)) - 33 as q from (select *, unnest(range(1, length(sequence) + 1)) as i from reads))"


@query("a01_read_stats", f"with {READS} select sample, min(length(sequence)) as min_length, max(length(sequence)) as max_length, cast(ceil(median(length(sequence))) as bigint) as median_length from reads group by sample")
def read_stats(spark, sf_dir):
    return ops.read_stats(views.reads(spark, sf_dir))


@query("a10_base_quality", f"with {_FLAT} select sample, mate, cast(pos as int) as pos, round(avg(q), 4) as mean_quality, quantile_cont(q, 0.1) as p10, quantile_cont(q, 0.25) as q1, quantile_cont(q, 0.5) as median_quality, quantile_cont(q, 0.75) as q3, quantile_cont(q, 0.9) as p90 from flat group by 1, 2, 3")
def base_quality(spark, sf_dir):
    return ops.base_quality_profile(views.reads(spark, sf_dir))


@query("a11_read_quality", f"with {READS} select sample, mate, cast(floor(list_sum({_Q}) / cast(length(quality) as double)) as int) as quality, count(*) as n_reads from reads group by 1, 2, 3")
def read_quality(spark, sf_dir):
    return ops.per_read_quality(views.reads(spark, sf_dir))


@query("a11_base_content", f"with {_FLAT} select sample, mate, cast(pos as int) as pos, " + ", ".join(f"round(100.0 * count(*) filter (where base = '{b}') / count(*), 4) as pct_{b}" for b in "acgt") + " from flat group by 1, 2, 3")
def base_content(spark, sf_dir):
    return ops.base_content(views.reads(spark, sf_dir))


@query("a09_gc_histogram", f"with {READS}, g as (select sample, mate, cast(floor(100.0 * length(regexp_replace(sequence, '[^gc]', '', 'g')) / length(sequence) + 0.5) as int) as gc, count(*) as n from reads group by 1, 2, 3) select *, round(100.0 * n / sum(n) over (partition by sample, mate), 6) as pct from g")
def gc_histogram(spark, sf_dir):
    return ops.gc_histogram(views.reads(spark, sf_dir))


@query("j13_length_grid", f"with {READS}, c as (select sample, mate, length(sequence) as length, count(*) as n from reads group by 1, 2, 3), s as (select distinct sample, mate from c), l as (select cast(unnest(range((select min(length) from c), (select max(length) from c) + 1)) as bigint) as length) select sample, mate, length, coalesce(n, 0) as n from (select * from s, l) left join c using (sample, mate, length)")
def length_grid(spark, sf_dir):
    return ops.length_grid(views.reads(spark, sf_dir, quality=False))


@query("a11_duplication", f"with {READS}, c as (select sample, sequence, count(*) as n from reads group by 1, 2) select sample, case when n >= 100 then '>100' when n >= 50 then '>50' when n >= 10 then '>10' else cast(n as varchar) end as level, cast(sum(n) as bigint) as n_reads, count(*) as n_distinct from c group by 1, 2")
def duplication(spark, sf_dir):
    return ops.duplication_levels(views.reads(spark, sf_dir))


@query("a08_qc_summary", f"with {_FLAT}, r as (select sample, read_id, count(*) as n, count(*) filter (where q >= 20) as q20, count(*) filter (where q >= 30) as q30, count(*) filter (where base in ('g', 'c')) as gc from flat group by 1, 2) select sample, count(*) as n_reads, cast(sum(n) as bigint) as n_bases, round(avg(n), 4) as mean_length, round(100.0 * sum(q20) / sum(n), 4) as pct_q20, round(100.0 * sum(q30) / sum(n), 4) as pct_q30, round(100.0 * sum(gc) / sum(n), 4) as pct_gc from r group by 1")
def qc_summary(spark, sf_dir):
    return ops.qc_summary(views.reads(spark, sf_dir))


@query("c06_last_base_bias", f"with {READS}, t as (select *, max(length(sequence)) over (partition by sample) as top from reads), e as (select sample, right(sequence, 1) as b from t where length(sequence) = top), s as (select sample, 100.0 * (count(*) filter (where b = 'a') - count(*) filter (where b = 't')) / count(*) as at_, 100.0 * (count(*) filter (where b = 'c') - count(*) filter (where b = 'g')) / count(*) as cg from e group by 1) select sample, round(at_, 4) as at_bias, round(cg, 4) as cg_bias, abs(at_) > 10 or abs(cg) > 10 as trim from s")
def last_base_bias(spark, sf_dir):
    return ops.last_base_bias(views.reads(spark, sf_dir))


@query("c31_quality_offset", f"with {_FLAT} select sample, cast(pos as int) as pos, cast(max(q + pos % 3 * 4) - case when max(max(q + pos % 3 * 4)) over (partition by sample) > 42 then 31 else 0 end as bigint) as q from flat group by sample, pos")
def quality_offset(spark, sf_dir):
    flat = views.reads(spark, sf_dir).select("sample", F.posexplode(ops.phred(F.col("quality"))).alias("pos", "q"))
    top = flat.groupBy("sample", "pos").agg(F.max(F.col("q") + F.col("pos") % 3 * 4).cast("long").alias("q"))
    return ops.fix_quality_offset(top)


@query(
    "q08_quality_trim",
    f"""with {READS}, g as (select *, {_Q} as qs from reads), b as (select *, list_position([x >= 20 for x in qs], true) as first, length(quality) - list_position(list_reverse([x >= 20 for x in qs]), true) + 1 as last from g),
    c as (select sample, read_id, substr(sequence, first, last - first + 1) as sequence, substr(quality, first, last - first + 1) as quality, qs[first:last] as qs from b where first > 0)
    select sample, read_id, sequence, quality from c where length(sequence) >= 25 and list_sum(qs) / cast(len(qs) as double) >= 20""",
)
def quality_trim(spark, sf_dir):
    return ops.trim_quality(views.reads(spark, sf_dir), trim=20, mean=20).select("sample", "read_id", "sequence", "quality")


_ADAPTORS = "adaptors as (select 'ad' || region_key as name, s as sequence from (select r_regionkey as region_key, substr(translate(regexp_replace(lower(r_name || r_name || r_name || r_name || r_name), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac'), 1, 24) as s from region))"


def _adaptors(spark, sf_dir):
    region = views.table(spark, sf_dir, "region")
    name = F.lower(F.concat(*["r_name"] * 5))
    return region.select(F.concat(F.lit("ad"), F.col("r_regionkey").cast("string")).alias("name"), F.substring(F.translate(F.regexp_replace(name, "[^a-z]", ""), views._FROM, views._TO), 1, 24).alias("sequence"))


@query(
    "q07_adaptor_trim",
    f"""with {READS}, {_ADAPTORS}, k as (select name, substr(sequence, i, 6) as kmer from (select *, unnest(range(1, length(sequence) - 4)) as i from adaptors)),
    n0 as (select min(name) as adaptor, kmer from k group by kmer),
    n1 as (select distinct name as adaptor, substr(kmer, 1, p - 1) || b || substr(kmer, p + 1) as kmer from (select *, unnest(range(1, 7)) as p from k), (select unnest(['a', 'c', 'g', 't']) as b)),
    near as (select kmer, min(adaptor) as adaptor from n1 group by kmer),
    places as (select sample, read_id, i - 1 as pos, substr(sequence, i, 6) as kmer from (select *, unnest(range(1, length(sequence) - 4)) as i from reads where length(sequence) >= 6)),
    hit as (select sample, read_id, min({{'pos': pos, 'adaptor': adaptor}}) as h from places join near using (kmer) group by 1, 2)
    select r.sample, r.read_id, h.adaptor as adaptor, cast(coalesce(h.pos, length(sequence)) as int) as kept from reads r left join hit using (sample, read_id)""",
)
def adaptor_trim(spark, sf_dir):
    out = ops.trim_adaptors(views.reads(spark, sf_dir), _adaptors(spark, sf_dir), k=6, distance=1)
    return out.select("sample", "read_id", "adaptor", F.length("sequence").alias("kept"))


@query("l04_sample_reads", f"with {READS}, f as (select sample, read_id, sum(length(sequence)) as n from reads group by 1, 2), r as (select *, sum(n) over (partition by sample order by md5(read_id || '0'), read_id rows unbounded preceding) as upto from f) select sample, read_id from reads join r using (sample, read_id) where upto <= 20000")
def sample_reads(spark, sf_dir):
    return ops.sample_reads(views.reads(spark, sf_dir), bases=20_000).select("sample", "read_id")


@query("a13_wide_counts", "select l_shipmode_ as adaptor, R as \"R\", A as \"A\", N as \"N\", R + A + N as total from (select l_linestatus as l_shipmode_, count(*) filter (where l_returnflag = 'R') as R, count(*) filter (where l_returnflag = 'A') as A, count(*) filter (where l_returnflag = 'N') as N from lineitem group by 1)")
def wide_counts(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("adaptor"), F.col("l_returnflag").alias("sample"))
    return ops.adaptor_counts(items, ["R", "A", "N"])


def _passage_adaptors(spark, sf_dir):
    text = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), views._FROM, views._TO)
    return views.table(spark, sf_dir, "benchmark").select(F.format_string("ad%05d", "item_id").alias("name"), F.substring(text, 1, 34).alias("sequence"))


@query("q07_default_rounds")
def default_rounds(spark, sf_dir):
    """Both rounds at their default k and distance: adaptors are the first 34 bases of every benchmark passage."""
    out = ops.trim_adaptors_in_rounds(views.reads(spark, sf_dir), _passage_adaptors(spark, sf_dir))
    return out.select("sample", "read_id", "adaptor_1", "adaptor_2", F.length("sequence").alias("kept"))
