"""Queries over assemblies."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import assembly as ops

from . import views
from .registry import query
from .views import CONTIGS

_GC = "length(regexp_replace(upper(sequence), '[^GC]', '', 'g'))"
_ACGT = "length(regexp_replace(upper(sequence), '[^ACGT]', '', 'g'))"
_STEPS = ",\n".join(
    f"round(100.0 * count(*) filter (where length >= {s}) / count(*), 4) as pct_contigs_{s}, round(100.0 * coalesce(sum(length) filter (where length >= {s}), 0) / nullif(sum(length), 0), 4) as pct_length_{s}" for s in ops.LENGTH_STEPS
)


@query(
    "a02_assembly_stats",
    f"""with {CONTIGS} select sample, count(*) as n_contigs, cast(sum(length) as bigint) as total_length, min(length) as shortest, max(length) as longest,
    round(avg(length), 4) as mean_length, median(length) as median_length, round(100.0 * sum({_GC}) / nullif(sum({_ACGT}), 0), 4) as gc,
    round(avg(depth), 4) as mean_depth, median(depth) as median_depth, {_STEPS} from contigs group by sample""",
)
def assembly_stats(spark, sf_dir):
    return ops.assembly_stats(views.contigs(spark, sf_dir), ["sample"])


@query(
    "w02_n50",
    f"""with {CONTIGS}, r as (select sample, length, sum(length) over w as upto, row_number() over w as rn, sum(length) over (partition by sample) as total
      from contigs window w as (partition by sample order by length desc, contig rows between unbounded preceding and current row))
    select sample, """
    + ", ".join(f"max(length) filter (where upto >= total * {x}) as n{round(100 * x)}, min(rn) filter (where upto >= total * {x}) as l{round(100 * x)}" for x in (0.5, 0.75, 0.9))
    + " from r group by sample",
)
def n50(spark, sf_dir):
    return ops.nx_lx(views.contigs(spark, sf_dir), ["sample"])


@query("p08_filter_contigs", f"with {CONTIGS} select sample, contig, gc, gc <= 52 and depth >= 1.5 as accepted from (select *, coalesce(round(100.0 * {_GC} / nullif({_ACGT}, 0), 5), 0) as gc from contigs)")
def filter_contigs(spark, sf_dir):
    return ops.filter_contigs(views.contigs(spark, sf_dir), max_gc=52).select("sample", "contig", "gc", "accepted")


def _bin(col: str, steps: tuple[tuple[int, str], ...]) -> str:
    whens = " ".join(f"when {col} <= {top} then greatest(1.0, ceil({col} / {w})) * {w}" for top, w in steps)
    return f"case {whens} else cast('infinity' as double) end"


_DEPTH = _bin("depth", ((5, "0.5"), (50, "5.0"), (500, "50.0"), (5000, "500.0")))
_LENGTH = _bin("length", ((500, "50.0"), (5000, "500.0"), (50000, "5000.0")))


def _hist(bin_sql: str) -> str:
    return f"""with {CONTIGS}, h as (select sample, cast({bin_sql} as double) as bin, count(*) as n_contigs, cast(sum(length) as bigint) as n_bases from contigs group by 1, 2)
    select *, round(coalesce(n_bases / nullif(cast(sum(n_bases) over (partition by sample) as double), 0), 0), 6) as fraction from h"""


@query("a03_depth_histogram", _hist(_DEPTH))
def depth_histogram(spark, sf_dir):
    return ops.histogram(views.contigs(spark, sf_dir), ["sample"], ops.depth_bin(F.col("depth")))


@query("a03_length_histogram", _hist(_LENGTH))
def length_histogram(spark, sf_dir):
    return ops.histogram(views.contigs(spark, sf_dir), ["sample"], ops.length_bin(F.col("length")))


@query("a27_populated_bins", f"select *, '≤' || cast(bin as bigint) as label from ({_hist(_LENGTH)}) where bin < cast('infinity' as double) and bin <= (select max(bin) from ({_hist(_LENGTH)}) where n_bases > 0 and bin < cast('infinity' as double)) and bin >= (select min(bin) from ({_hist(_LENGTH)}) where n_bases > 0)")
def populated_bins(spark, sf_dir):
    bins = ops.histogram(views.contigs(spark, sf_dir), ["sample"], ops.length_bin(F.col("length")))
    return ops.trim_to_populated(bins.where(F.col("bin") < float("inf")), ["sample"])


_NAMES = f"""with {CONTIGS}, named as (select sample, 'NODE_' || contig || '_length_' || length || '_cov_' || depth as name from contigs)"""


@query("p01_contig_names", f"""{_NAMES} select sample, name as contig, try_cast(regexp_extract(name, '_length_([0-9.]+)', 1) as int) as length, try_cast(regexp_extract(name, '_cov_([0-9.]+)', 1) as double) as depth from named""")
def contig_names(spark, sf_dir):
    c = views.contigs(spark, sf_dir)
    named = c.select("sample", F.concat(F.lit("k141_"), "contig", F.lit(" flag=1 multi="), F.col("depth").cast("string"), F.lit(" len="), F.col("length").cast("string")).alias("name"))
    return ops.parse_headers(named).select("sample", F.regexp_replace("contig", "_k_141_flag_1$", "").alias("contig"), "length", "depth")


@query("j06_recomputed_depth", f"with {CONTIGS}, q as (select c.sample, c.contig, c.length, count(*) as num_reads from contigs c join lineitem on l_suppkey = cast(c.contig as bigint) where c.length > 0 group by all) select sample, contig, num_reads, round(num_reads * 151 * 2 / cast(length as double), 4) as depth from q")
def recomputed_depth(spark, sf_dir):
    reads = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("contig")).agg(F.count(F.lit(1)).alias("num_reads"))
    quant = views.contigs(spark, sf_dir).where("length > 0").join(reads, "contig")
    return ops.recomputed_depth(quant, 151, paired=True).select("sample", "contig", "num_reads", "depth")


@query("u02_leftover_contigs", f"with {CONTIGS} select sample, contig, length from contigs where cast(contig as bigint) not in (select l_suppkey from lineitem)")
def leftover_contigs(spark, sf_dir):
    hit = views.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("contig"))
    return views.contigs(spark, sf_dir).join(hit, "contig", "left_anti").select("sample", "contig", "length")


@query("j07_hit_contigs", f"with {CONTIGS} select sample, contig, length from contigs where cast(contig as bigint) in (select l_suppkey from lineitem)")
def hit_contigs(spark, sf_dir):
    hit = views.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("contig"))
    return views.contigs(spark, sf_dir).join(hit, "contig", "left_semi").select("sample", "contig", "length")


@query("c01_reverse_complement", f"with {CONTIGS} select contig, translate(reverse(sequence), 'acgt', 'tgca') as reverse_complement from contigs")
def reverse_complement(spark, sf_dir):
    return views.contigs(spark, sf_dir).select("contig", seq.reverse_complement(F.col("sequence")).alias("reverse_complement"))


_CODE = {k: seq.codon_table(1, last=k == "last") for k in ("mid", "last")}


def _aa(source: str, frame: int) -> str:
    pick = lambda t: f"case when strpos(' {_CODE[t]}', ' ' || c) > 0 then substr(' {_CODE[t]}', strpos(' {_CODE[t]}', ' ' || c) + 4, 1) else 'X' end"
    codons = f"regexp_extract_all(substr({source}, {abs(frame)}), '...')"
    mid = f"array_to_string(list_transform(list_slice({codons}, 1, len({codons}) - 1), lambda c: {pick('mid')}), '')"
    last = f"(list_transform(list_slice({codons}, len({codons}), len({codons})), lambda c: {pick('last')}))[1]"
    return f"case when len({codons}) = 0 then '' else {mid} || {last} end"


_FWD, _REV = "upper(sequence)", "upper(translate(reverse(sequence), 'acgt', 'tgca'))"


@query("c03_translate", f"with {CONTIGS} select contig, {_aa(_FWD, 1)} as frame1, {_aa(_FWD, 3)} as frame3, {_aa(_REV, 2)} as frame_2 from contigs")
def translate(spark, sf_dir):
    s = F.col("sequence")
    return views.contigs(spark, sf_dir).select("contig", seq.translate(s).alias("frame1"), seq.translate(s, frame=3).alias("frame3"), seq.translate(s, frame=-2).alias("frame_2"))


_TRIED = ", ".join(
    f"{{'stops': len({a}) - len(replace(regexp_replace({a}, '\\*$', ''), '*', '')) - (case when {a} like '%*' then 1 else 0 end), 'unknown': len({a}) - len(replace({a}, 'X', '')), 'place': {i}, 'frame': {f}}}"
    for i, (f, a) in enumerate(zip((1, 2, 3, -1, -2, -3), ("a1", "a2", "a3", "b1", "b2", "b3"), strict=True))
)


@query(
    "c04_best_frame",
    f"""with {CONTIGS}, t as (select contig, {_aa(_FWD, 1)} as a1, {_aa(_FWD, 2)} as a2, {_aa(_FWD, 3)} as a3, {_aa(_REV, 1)} as b1, {_aa(_REV, 2)} as b2, {_aa(_REV, 3)} as b3 from contigs),
    s as (select contig, list_sort([{_TRIED}])[1] as best from t)
    select contig, best.frame as frame, cast(best.stops as int) as stops from s""",
)
def best_frame(spark, sf_dir):
    found = views.contigs(spark, sf_dir).select("contig", seq.best_frame(F.col("sequence")).alias("best"))
    return found.select("contig", "best.frame", F.col("best.stops").cast("int").alias("stops"))


@query("p04_sequence_kind", "select l_returnflag || l_linestatus as text, case when bool_and(regexp_full_match(l_returnflag || l_linestatus, '[ACGTMRWSYKVHDBN?-]*')) then 'NT' else 'AA' end as kind from lineitem group by 1")
def sequence_kind(spark, sf_dir):
    t = F.concat("l_returnflag", "l_linestatus")
    return views.table(spark, sf_dir, "lineitem").groupBy(t.alias("text")).agg(F.min(seq.sequence_kind(t)).alias("kind"))
