"""Queries over alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import sites as ops

from . import views
from .registry import query
from .views import ALIGNMENTS

K = ["locus"]
_MARK = "case when length(ltrim(sequence, '-')) = 0 then repeat('#', length(sequence)) else repeat('#', length(sequence) - length(ltrim(sequence, '-'))) || trim(sequence, '-') || repeat('#', length(sequence) - length(rtrim(sequence, '-'))) end"
_FLAT = f"{ALIGNMENTS}, flat as (select locus, seq_name, i - 1 as pos, substr(s, i, 1) as residue, substr(sequence, i, 1) as raw from (select *, {_MARK} as s, unnest(range(1, 121)) as i from alignments))"
_P = {b: "case residue " + " ".join(f"when '{a}' then {1 / len(s)!r}" for a, s in seq.NT_LETTERS.items() if b in s) + " else 0 end" for b in "ACGT"}
_SITES = f"""{_FLAT}, counts as (select locus, pos, residue, count(*) as n from flat group by 1, 2, 3), sums as (select locus, pos, sum(n) as rows_, sum(n) filter (where residue <> '#') as inner_,
    coalesce(sum(n) filter (where residue = '-'), 0) as gaps, coalesce(sum(n) filter (where residue in ('?', '.', '~', 'O', 'N', 'X', '#', '-')), 0) as missing,
    {", ".join(f"sum(n * {p}) as s{b}, sum(n * ({p}) * ({p})) as q{b}, coalesce(sum(n) filter (where ({p}) > 0 and residue <> 'N'), 0) as c{b}" for b, p in _P.items())} from counts group by 1, 2),
  sites as (select locus, pos, rows_, gaps, missing, case when rows_ = missing or greatest(cA, cC, cG, cT) = rows_ - missing then 'constant'
    when (cA >= 2)::int + (cC >= 2)::int + (cG >= 2)::int + (cT >= 2)::int >= 2 then 'informative' else 'singleton' end as class,
    case when coalesce(inner_, 0) >= 2 then ({" + ".join(f"s{b} * s{b} - q{b}" for b in "ACGT")}) / 2 else 0 end as matches,
    case when coalesce(inner_, 0) >= 2 then inner_ * (inner_ - 1) / 2 - gaps * (gaps - 1) / 2 else 0 end as pairs from sums)"""


def _aln(spark, sf_dir):
    return views.alignments(spark, sf_dir)


@query("c16_site_classes", f"with {_SITES} select locus, cast(pos as int) as pos, class, cast(missing as bigint) as missing, round(cast(matches as double), 6) as matches, cast(pairs as double) as pairs from sites")
def site_classes(spark, sf_dir):
    sites = ops.site_stats(ops.site_counts(_aln(spark, sf_dir), K), K)
    return sites.select("locus", "pos", "class", "missing", F.round("matches", 6).alias("matches"), "pairs")


_GCW = "length(regexp_replace({0}, '[^GCS]', '', 'g')) + length(regexp_replace({0}, '[^RYKMN]', '', 'g')) / 2.0 + length(regexp_replace({0}, '[^VB]', '', 'g')) * 2.0 / 3.0 + length(regexp_replace({0}, '[^HD]', '', 'g')) / 3.0"
_LET = "length(regexp_replace({0}, '[^ACGTMRWSYKVHDBN]', '', 'g'))"
_BARE = "replace(upper(sequence), '-', '')"
_COPIES = f"{ALIGNMENTS}, copies as (select locus, sample, count(*) as copies from alignments where not is_ref and {_BARE} <> '' group by 1, 2)"


@query(
    "a05_alignment_stats",
    f"""with {_SITES}, patterns as (select locus, count(distinct p) as patterns from (select locus, pos, string_agg(case when residue in ('?', '.', '~', 'O', 'N', 'X', '#') then '-' else residue end, '' order by seq_name) as p from flat group by 1, 2) group by 1),
    m as (select locus, count(*) as sites, count(*) filter (where class = 'informative') as informative, count(*) filter (where class = 'constant') as constant, count(*) filter (where class = 'singleton') as singleton,
      round(100.0 * count(*) filter (where class = 'informative') / count(*), 2) as informativeness, round(cast(100.0 * sum(matches) / nullif(sum(pairs), 0) as double), 2) as mean_pid, round(100.0 * sum(missing) / sum(rows_), 2) as missingness from sites group by 1),
    r as (select locus, count(*) as sequences, round(cast(100.0 * sum({_GCW.format(_BARE)}) / nullif(sum({_LET.format(_BARE)}), 0) as double), 2) as gc from alignments group by 1),
    c as (select locus, count(*) as samples, median(copies) as median_copies from (select locus, sample, count(*) as copies from alignments where not is_ref and {_BARE} <> '' group by 1, 2) group by 1)
    select *, round(sequences / cast(samples as double), 2) as mean_copies from r join m using (locus) join patterns using (locus) left join c using (locus)""",
)
def alignment_stats(spark, sf_dir):
    return ops.alignment_stats(_aln(spark, sf_dir), K)


@query("a04_copies", f"with {_COPIES} select locus, count(*) as samples, cast(sum(copies) as bigint) as total_copies, median(copies) as median_copies from copies group by 1")
def copy_counts(spark, sf_dir):
    return ops.copy_stats(_aln(spark, sf_dir), K)


@query("q27_kept_loci", f"with {_COPIES}, g as (select locus from copies group by 1 having count(*) >= 10 and median(copies) <= 3) select locus, seq_name from alignments where locus in (select locus from g)")
def kept_loci(spark, sf_dir):
    return ops.keep_loci(_aln(spark, sf_dir), K, min_samples=10, max_copies=3).select("locus", "seq_name")


_SAMPLE = f"""one as (select locus, sample, length(sequence) as len_total, length(trim(sequence, '-')) as len_gapped, length({_BARE}) as len_ungapped, length(regexp_replace({_BARE}, '[^MRWSYKVHDBN?]', '', 'g')) as ambigs,
      100.0 * ({_GCW.format(_BARE)}) / nullif({_LET.format(_BARE)}, 0) as gc from alignments),
    st as (select locus, sample, max(len_total) as len_total, round(avg(len_gapped), 2) as len_gapped, round(avg(len_ungapped), 2) as len_ungapped, round(avg(ambigs), 2) as ambigs, round(cast(avg(gc) as double), 2) as gc, count(*) as copies from one group by 1, 2)"""


@query("a06_sample_stats", f"with {ALIGNMENTS}, {_SAMPLE} select * from st")
def sample_stats(spark, sf_dir):
    return ops.sample_stats(_aln(spark, sf_dir), K)


@query("a07_sample_summary", f"with {ALIGNMENTS}, {_SAMPLE} select sample, count(*) as loci, round(sum(len_ungapped), 2) as total_length, round(avg(len_gapped), 4) as mean_len_gapped, round(avg(gc), 4) as mean_gc, round(avg(copies), 4) as mean_copies, median(copies) as median_copies from st group by 1")
def sample_summary(spark, sf_dir):
    return ops.sample_summary(ops.sample_stats(_aln(spark, sf_dir), K))


_CODON = "regexp_replace(substr({0}, {1}), '(.).{{0,2}}', '\\1', 'g')"


@query("a05_gc_codon", f"with {ALIGNMENTS}, b as (select locus, {_BARE} as s from alignments) select locus, " + ", ".join(f"round(cast(100.0 * sum({_GCW.format(c)}) / nullif(sum({_LET.format(c)}), 0) as double), 2) as gc_codon_p{i}" for i in (1, 2, 3) for c in [_CODON.format("s", i)]) + " from b group by 1")
def gc_codon(spark, sf_dir):
    return ops.gc_by_codon(_aln(spark, sf_dir), K)


@query("c15_terminal_gaps", f"with {ALIGNMENTS} select seq_name, {_MARK} as sequence from alignments")
def terminal_gaps(spark, sf_dir):
    return _aln(spark, sf_dir).select("seq_name", seq.mark_terminal_gaps(F.col("sequence")).alias("sequence"))


def _kept(select: str) -> str:
    return f"""with {_SITES}, shares as (select locus, pos, count(*) filter (where raw = '-') / cast(count(*) as double) as gap_share from flat group by 1, 2),
    kept as ({select}) select f.locus, f.seq_name, string_agg(f.raw, '' order by f.pos) as sequence from flat f join kept k on f.locus = k.locus and f.pos = k.pos group by 1, 2"""


@query("q03_drop_empty_columns", _kept("select locus, pos from flat group by 1, 2 having count(*) filter (where raw <> '-') > 0"))
def drop_empty(spark, sf_dir):
    return ops.drop_empty_columns(_aln(spark, sf_dir), K).select("locus", "seq_name", "sequence")


@query("q05_trim_gappy", _kept("select locus, pos from shares where gap_share <= 0.15"))
def trim_gappy(spark, sf_dir):
    return ops.trim_columns(_aln(spark, sf_dir), K, "gappy", gaps=0.15).select("locus", "seq_name", "sequence")


@query("q05_trim_kpic_gappy", _kept("select locus, pos from sites join shares using (locus, pos) where gap_share <= 0.15 and (class = 'informative' or class = 'constant' and missing < rows_)"))
def trim_kpic(spark, sf_dir):
    return ops.trim_columns(_aln(spark, sf_dir), K, "kpic-gappy", gaps=0.15).select("locus", "seq_name", "sequence")


@query("q05_trim_codons", _kept("select distinct locus, unnest([pos // 3 * 3, pos // 3 * 3 + 1, pos // 3 * 3 + 2]) as pos from shares where gap_share <= 0.1"))
def trim_codons(spark, sf_dir):
    return ops.trim_columns(_aln(spark, sf_dir), K, "gappy", gaps=0.1, codons=True).select("locus", "seq_name", "sequence")


@query("q05_trim_block", _kept("select locus, unnest(range(min(pos), max(pos) + 1)) as pos from shares where gap_share <= 0.1 group by locus"))
def trim_block(spark, sf_dir):
    return ops.trim_columns(_aln(spark, sf_dir), K, "block-gappy", gaps=0.1).select("locus", "seq_name", "sequence")


@query("q05_trim_min_data", _kept("select s.locus, pos from shares s join (select locus, count(*) as n from alignments group by 1) using (locus) where gap_share <= case when n = 9 then 1.0 when n < 10 then round_even(1 - least(n, 9) / cast(n as double), 1) when n < 100 then round_even(1 - 9 / cast(n as double), 2) when n < 1000 then round_even(1 - 9 / cast(n as double), 3) else round_even(1 - 9 / cast(n as double), 4) end"))
def trim_min_data(spark, sf_dir):
    """Sites with data in nine rows, by the threshold that each locus's number of rows gives."""
    return ops.trim_columns(_aln(spark, sf_dir), K, "gappy", min_data=9).select("locus", "seq_name", "sequence")


@query("w09_depth_trim", _kept("select locus, unnest(range(min(pos), max(pos) + 1)) as pos from (select locus, p as pos from (select *, unnest(range(0, 120)) as p from (select locus, length(sequence) - length(ltrim(sequence, '-')) as a, length(rtrim(sequence, '-')) as b from alignments)) group by 1, 2 having count(*) filter (where a <= p and p < b) >= floor(count(*) * 0.88)) group by locus"))
def depth_trim(spark, sf_dir):
    return ops.trim_by_depth(_aln(spark, sf_dir), K, gaps=0.12).select("locus", "seq_name", "sequence")


@query("q04_short_rows", f"with {ALIGNMENTS}, n as (select *, length({_BARE}) as n from alignments) select locus, seq_name from n where n >= 0.9 * (select median(m.n) from n m where m.locus = n.locus and m.n > 0)")
def short_rows(spark, sf_dir):
    return ops.drop_short_rows(_aln(spark, sf_dir), K, share=0.9).select("locus", "seq_name")


def _refs(aln):
    return aln.where("is_ref").groupBy("locus", "target").agg(F.min_by("sequence", "seq_name").alias("sequence"))


_REFS = "refs as (select locus, target, arg_min(sequence, seq_name) as sequence from alignments where is_ref group by 1, 2)"
_OVER = "substr({0}, cast(f + 1 as bigint), cast(greatest(l - f, 0) as bigint))"
_VALUE = "case " + " ".join(f"when x = '{a}' and y = '{b}' then {v!r}" for k, v in seq.pair_identity("NT").items() if v > 0 for a, b in {(k[0], k[1]), (k[1], k[0])}) + " else 0 end"
_PID = f"""model as (select locus, target from (select locus, target, row_number() over (partition by locus order by count(*) desc, target) as k from alignments where not is_ref and rank = 0 group by 1, 2) where k = 1),
    best as (select locus, target, r.sequence as ref from model join refs r using (locus, target)),
    own as (select a.locus, a.sample, a.seq_name, a.rank, b.target, b.ref, a.sequence as s, greatest(length(ref) - length(ltrim(ref, '-')), length(a.sequence) - length(ltrim(a.sequence, '-'))) as f, least(length(rtrim(ref, '-')), length(rtrim(a.sequence, '-'))) as l
      from alignments a join best b using (locus) where not a.is_ref),
    pairs as (select seq_name, substr(ref, i, 1) as x, substr(s, i, 1) as y from (select *, unnest(range(cast(f + 1 as bigint), cast(l + 1 as bigint))) as i from own where l > f)),
    pid as (select seq_name, round(coalesce(100.0 * sum(v) filter (where x <> '-' and y <> '-') / nullif(count(*) filter (where x <> '-' and y <> '-'), 0), 0), 5) as pid from (select *, cast({_VALUE} as double) as v from pairs) group by 1),
    scored as (select own.*, coalesce(pid.pid, 0) as pid, round(pow(coalesce(pid.pid, 0) / 100, 2) * sqrt(coalesce(length(trim(s, '-')) / nullif(cast(length(trim(ref, '-')) as double), 0), 0)), 5) as score from own left join pid using (seq_name)),
    firsts as (select *, row_number() over (partition by locus, sample order by score desc, rank, seq_name) = 1 as first from scored)"""


@query("q02_informed_paralogs", f"with {ALIGNMENTS}, {_REFS}, {_PID}, lim as (select locus, avg(pid) - 1.0 * stddev_samp(pid) as least from firsts where first group by 1) select locus, sample, seq_name, target, pid, score, first and coalesce(pid >= least, true) as accepted from firsts join lim using (locus)")
def informed_paralogs(spark, sf_dir):
    aln = _aln(spark, sf_dir)
    return ops.filter_paralogs_informed(aln, _refs(aln), K, tolerance=1.0)


@query("q02_accepted_in_all_formats", f"""with {ALIGNMENTS}, {_REFS}, {_PID}, lim as (select locus, avg(pid) - 1.0 * stddev_samp(pid) as least from firsts where first group by 1), ok as (select locus, seq_name from firsts join lim using (locus) where first and coalesce(pid >= least, true)),
    al as (select *, unnest(['NT', 'GE']) as format from alignments), kp as (select * from al where is_ref union all select al.* from al join ok using (locus, seq_name) where not is_ref), en as (select locus, format from kp where not is_ref group by 1, 2 having count(distinct sample) >= 3)
    select locus, format, seq_name, is_ref from kp join en using (locus, format)""")
def accepted_in_all_formats(spark, sf_dir):
    aln = _aln(spark, sf_dir)
    judged = ops.filter_paralogs_informed(aln, _refs(aln), K, tolerance=1.0)
    rows = aln.withColumn("format", F.explode(F.array(F.lit("NT"), F.lit("GE"))))
    return ops.apply_accepted(rows, judged, K, ["locus", "format"], min_samples=3).select("locus", "format", "seq_name", "is_ref")


@query("q01_naive_paralogs", f"with {ALIGNMENTS}, n as (select * from alignments where is_ref or rank = 0), g as (select locus from n where not is_ref and {_BARE} <> '' group by 1 having count(distinct sample) >= 4) select locus, seq_name, sample from n where locus in (select locus from g)")
def naive_paralogs(spark, sf_dir):
    return ops.filter_paralogs_naive(_aln(spark, sf_dir), K).select("locus", "seq_name", "sample")


@query("j02_add_references", f"with {ALIGNMENTS}, {_REFS} select locus, target, sequence from refs where (locus, target) in (select (locus, target) from alignments where not is_ref)")
def add_references(spark, sf_dir):
    aln = _aln(spark, sf_dir)
    return ops.add_references(aln, _refs(aln), K)


@query("j03_remove_references", f"with {ALIGNMENTS} select locus, seq_name from alignments where not is_ref")
def remove_references(spark, sf_dir):
    aln = _aln(spark, sf_dir)
    return ops.remove_references(aln, aln.where("is_ref").select("seq_name")).select("locus", "seq_name")


@query(
    "j12_supermatrix",
    f"""with {ALIGNMENTS}, own as (select * from alignments where not is_ref), best as (select sample, locus, arg_min(sequence, row(rank, seq_name)) as s from own group by 1, 2),
    grid as (select sample, locus, width from (select distinct sample from own), (select locus, max(length(sequence)) as width from own group by 1))
    select sample, count(s) as loci_present, string_agg(coalesce(s, repeat('-', width)), '' order by locus) as sequence from grid left join best using (sample, locus) group by 1""",
)
def supermatrix(spark, sf_dir):
    return ops.supermatrix(_aln(spark, sf_dir).where("not is_ref"))


@query("w05_partitions", f"with {ALIGNMENTS}, w as (select locus, max(length(sequence)) as width from alignments group by 1), o as (select locus, cast(sum(width) over (order by locus) as bigint) as end_, width from w) select locus, end_ - width + 1 as start, end_ as \"end\", (end_ - width + 1) || '-' || end_ || '\\3 ' || (end_ - width + 2) || '-' || end_ || '\\3' as sites from o")
def partitions(spark, sf_dir):
    return ops.partitions(_aln(spark, sf_dir).groupBy("locus").agg(F.max(F.length("sequence")).alias("width")), codon="12")


@query("k11_sequence_to_sample", f"with {ALIGNMENTS}, t as (select sample, max(rank) as top from alignments where not is_ref group by 1) select sample as name, sample from t union all select sample || '__' || lpad(cast(i as varchar), 2, '0'), sample from (select *, unnest(range(0, top + 1)) as i from t)")
def sequence_to_sample(spark, sf_dir):
    return ops.sequence_to_sample(_aln(spark, sf_dir))


@query("c25_codon_align", f"with {ALIGNMENTS}, p as (select seq_name, sequence as protein, repeat({_BARE}, 4) as bases from alignments), f as (select seq_name, i, substr(protein, i, 1) as c, bases, sum((substr(protein, i, 1) <> '-')::int) over (partition by seq_name order by i) as k from (select *, unnest(range(1, 121)) as i from p)) select seq_name, string_agg(case when c = '-' then '---' else substr(bases, cast(3 * (k - 1) + 1 as bigint), 3) end, '' order by i) as codons from f group by 1")
def codon_align(spark, sf_dir):
    bare = F.regexp_replace(F.upper("sequence"), "-", "")
    return _aln(spark, sf_dir).select("seq_name", ops.codon_align(F.col("sequence"), F.repeat(bare, F.lit(4))).alias("codons"))
