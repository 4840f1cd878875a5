"""Queries over k-mer similarity, grouped steps, files and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import gapped, grouped, similarity, stitch
from phylospark.operators import hits as hit_ops
from phylospark.operators import sites as site_ops
from phylospark.sources import readers, writers
from phylospark.streaming.ingest import ingest_new

from . import views
from .q_assembly import _REV, _aa
from .registry import query
from .views import ALIGNMENTS, CONTIGS, EXTRACTION, READS


def shared_folder(spark, name: str) -> str:
    """A fresh folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _saver(spark):
    def save(frame):
        path = shared_folder(spark, "step")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    return save


_FIRST = "short as (select sample, contig, upper(sequence) as s from contigs where length >= 31)"


@query(
    "q09_read_assignment",
    f"""with {READS}, {_FIRST}, ref as (select distinct sample, contig, least(k, translate(reverse(k), 'ACGT', 'TGCA')) as kmer from (select *, substr(s, i, 31) as k from (select *, unnest(range(1, length(s) - 29)) as i from short))),
    own as (select sample, read_id, least(k, translate(reverse(k), 'ACGT', 'TGCA')) as kmer from (select *, substr(upper(sequence), i, 31) as k from (select *, unnest(range(1, length(sequence) - 29, 10)) as i from reads where length(sequence) >= 31))),
    v as (select sample, read_id, contig, count(*) as votes from own join ref using (sample, kmer) group by 1, 2, 3), b as (select *, max(votes) over (partition by sample, read_id) as top from v),
    c as (select *, 1.0 / count(*) over (partition by sample, read_id) as share from b where votes = top) select sample, contig, round(sum(cast(share as double)), 6) as num_reads from c group by 1, 2""",
)
def read_assignment(spark, sf_dir):
    return similarity.assign_reads(views.reads(spark, sf_dir, quality=False), views.contigs(spark, sf_dir).where("length >= 31"))


_SEEDS = f"""{CONTIGS}, tg as (select cast(item_id as varchar) as target, upper(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{views._FROM}', '{views._TO}')) as s from benchmark), ct as (select contig, upper(sequence) as s from contigs where length >= 21),
    a as (select target, i as q, substr(s, i, 21) as kmer from (select *, unnest(range(1, length(s) - 19)) as i from tg where length(s) >= 21)), b as (select contig, i as t, substr(s, i, 21) as kmer from (select *, unnest(range(1, length(s) - 19)) as i from ct)),
    seeds as (select target, contig, t - q as diagonal, count(*) as seeds, min(q) - 1 as q_start, max(q) + 20 as q_end from a join b using (kmer) group by 1, 2, 3 having count(*) >= 3)"""


def _seeds(spark, sf_dir):
    text = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), views._FROM, views._TO)
    targets = views.table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("target"), text.alias("sequence"))
    return similarity.seed_hits(targets, views.contigs(spark, sf_dir).where("length >= 21"), k=21)


@query("q10_seed_hits", f"with {_SEEDS} select target, contig, diagonal, seeds, q_start, q_end, q_start + diagonal as t_start, q_end + diagonal as t_end from seeds")
def seed_hits(spark, sf_dir):
    return _seeds(spark, sf_dir)


_TARGETS = f"tg as (select cast(item_id as varchar) as target, upper(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{views._FROM}', '{views._TO}')) as s from benchmark)"


def _benchmark_targets(spark, sf_dir):
    text = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), views._FROM, views._TO)
    return views.table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("target"), text.alias("sequence"))


@query("q10_both_strands", f"with {CONTIGS}, {_TARGETS}, ct as (select contig, length, '+' as strand, upper(sequence) as s from contigs where length >= 21 union all select contig, length, '-', translate(reverse(upper(sequence)), 'ACGT', 'TGCA') from contigs where length >= 21), a as (select target, i as q, substr(s, i, 21) as kmer from (select *, unnest(range(1, length(s) - 19)) as i from tg where length(s) >= 21)), b as (select contig, length, strand, i as t, substr(s, i, 21) as kmer from (select *, unnest(range(1, length(s) - 19)) as i from ct)), h as (select target, contig, length, strand, t - q as diagonal, count(*) as seeds, min(q) - 1 as q_start, max(q) + 20 as q_end from a join b using (kmer) group by all having count(*) >= 3) select target, contig, strand, diagonal, seeds, q_start, q_end, case when strand = '-' then length - (q_end + diagonal) else q_start + diagonal end as t_start, case when strand = '-' then length - (q_start + diagonal) else q_end + diagonal end as t_end from h")
def both_strands(spark, sf_dir):
    return similarity.seed_hits_on_both_strands(_benchmark_targets(spark, sf_dir), views.contigs(spark, sf_dir).where("length >= 21"), k=21)


_SIX = " union all ".join(f"select contig, length, {f} as frame, {_aa('upper(sequence)' if f > 0 else _REV, f)} as s from contigs where length >= 21" for f in (1, 2, 3, -1, -2, -3))


@query("q10_translated", f"with {CONTIGS}, {_TARGETS}, pt as (select target, {_aa('s', 1)} as s from tg), ct as ({_SIX}), a as (select target, i as q, substr(s, i, 7) as kmer from (select *, unnest(range(1, length(s) - 5)) as i from pt where length(s) >= 7)), b as (select contig, length, frame, i as t, substr(s, i, 7) as kmer from (select *, unnest(range(1, length(s) - 5)) as i from ct where length(s) >= 7)), h as (select target, contig, length, frame, t - q as diagonal, count(*) as seeds, min(q) - 1 as q_start, max(q) + 6 as q_end from a join b using (kmer) group by all having count(*) >= 3), p as (select *, 3 * (q_start + diagonal) + abs(frame) - 1 as f, 3 * (q_end + diagonal) + abs(frame) - 1 as l from h) select target, contig, cast(frame as int) as frame, diagonal, seeds, q_start, q_end, case when frame < 0 then length - l else f end as t_start, case when frame < 0 then length - f else l end as t_end from p")
def translated(spark, sf_dir):
    proteins = _benchmark_targets(spark, sf_dir).withColumn("sequence", seq.translate(F.col("sequence")))
    return similarity.translated_hits(proteins, views.contigs(spark, sf_dir).where("length >= 21"), k=7)


@query("q10_colinear_hits", f"with {_SEEDS}, l as (select *, diagonal - lag(diagonal) over (partition by target, contig order by diagonal) as d from seeds), c as (select *, sum(case when d > 50 then 1 else 0 end) over (partition by target, contig order by diagonal) as chain from l) select target, contig, min(q_start) as q_start, max(q_end) as q_end, min(q_start + diagonal) as t_start, max(q_end + diagonal) as t_end, cast(sum(seeds) as bigint) as seeds, cast(count(*) as int) as block_count from c group by target, contig, chain")
def colinear_hits(spark, sf_dir):
    return similarity.colinear_hits(_seeds(spark, sf_dir)).drop("block_sizes", "q_starts", "t_starts")


@query("q10_gapped_hits")
def gapped_hits(spark, sf_dir):
    return gapped.gapped_hits(_benchmark_targets(spark, sf_dir), views.contigs(spark, sf_dir), k=15, min_seeded=30, min_score=60, min_identity=75.0)


@query("q12_deduplicated", f"with {CONTIGS}, c as (select *, upper(sequence) as u from contigs), k as (select *, least(u, translate(reverse(u), 'ACGT', 'TGCA')) as canonical from c) select sample, min(contig) as contig, arg_min(sequence, contig) as sequence, count(*) as copies from k group by sample, canonical")
def deduplicated(spark, sf_dir):
    return similarity.deduplicate(views.contigs(spark, sf_dir), ["sample"], "contig")


@query("q11_clusters")
def clusters(spark, sf_dir):
    c = views.contigs(spark, sf_dir).select(F.col("contig").alias("name"), "sequence")
    return similarity.cluster_sequences(c, identity=90.0, coverage=50.0, k=15, save=_saver(spark))


@query("q18_thinned_baits", f"with {CONTIGS} select contig as name, cast(i as int) as start from (select contig, unnest(range(1, length - 118, 60)) as i from contigs where length >= 120)")
def thinned_baits(spark, sf_dir):
    from phylospark.operators.targets import tile

    baits = tile(views.contigs(spark, sf_dir).withColumnRenamed("contig", "name"), step=20)
    return similarity.thin_baits(baits, step=20).select("name", ((F.col("bait_no") - 1) * 20 + 1).alias("start"))


@query("a22_minimum_copies")
def minimum_copies(spark, sf_dir):
    return grouped.minimum_copies(views.alignments(spark, sf_dir).where("not is_ref"), ["locus"])


def _partial(spark, sf_dir):
    h = views.hits(spark, sf_dir, wide=True)
    return h.withColumn("region", hit_ops.hit_region(*[F.col(c) for c in ("q_size", "q_start", "q_end", "t_size", "t_start", "t_end", "strand")]))


@query("j10_greedy_paths")
def greedy_paths(spark, sf_dir):
    return grouped.greedy_paths(_partial(spark, sf_dir), ["sample", "locus"])


@query("j11_stitched_hits")
def stitched_hits(spark, sf_dir):
    h = _partial(spark, sf_dir)
    return grouped.stitched(h, grouped.greedy_paths(h, ["sample", "locus"]), ["sample", "locus"])


@query("j11_stitched_sequences")
def stitched_sequences(spark, sf_dir):
    """Gapped hits of the benchmark passages, partial ones joined to copies, with the sequences of all their parts."""
    contigs = views.contigs(spark, sf_dir).where("length > 0")
    found = gapped.gapped_hits(_benchmark_targets(spark, sf_dir), contigs, k=15, min_seeded=30, min_score=40)
    size, start, end, t_size, t_start, t_end = (F.col(x) for x in ("q_size", "q_start", "q_end", "t_size", "t_start", "t_end"))
    matched = F.col("matches") + F.col("mismatches")
    hits = found.withColumns(
        {
            "hit_id": F.xxhash64("q_name", "t_name", "strand", "t_start", "q_start"), "contig": F.col("t_name"), "coverage": 100.0 * matched / size,
            "region": hit_ops.hit_region(size, start, end, t_size, t_start, t_end, F.col("strand")), "blocks": F.zip_with("t_starts", "block_sizes", lambda s, n: F.struct(s.alias("s"), (s + n).alias("e"))),
        }
    ).withColumn("wscore", hit_ops.weighted_score(F.col("identity"), F.col("coverage")))
    hits = _saver(spark)(hits.join(contigs.select("contig", "depth"), "contig"))
    paths = grouped.greedy_paths(hits, ["q_name"])
    return stitch.stitch_paths(hits, paths, contigs.select("contig", "sequence"), ["q_name"])


@query("q06_masked_outliers")
def masked_outliers(spark, sf_dir):
    return grouped.mask_outliers(views.alignments(spark, sf_dir), ["locus"])


@query("s01_fasta_round_trip", f"with {CONTIGS} select contig as name, sample as description, sequence from contigs where sequence <> ''")
def fasta_round_trip(spark, sf_dir):
    path = shared_folder(spark, "fasta")
    writers.write_fasta(views.contigs(spark, sf_dir).select(F.col("contig").alias("name"), F.col("sample").alias("description"), "sequence"), path, width=80)
    return readers.read_fasta(spark, path).select("name", "description", "sequence")


@query("s07_table_round_trip", f"with {EXTRACTION} select sample, locus, wscore, frameshifts from extraction")
def table_round_trip(spark, sf_dir):
    path = shared_folder(spark, "table")
    writers.write_table(views.extraction(spark, sf_dir).select("sample", "locus", "wscore", "frameshifts"), path)
    return readers.read_table(spark, path, "sample string, locus string, wscore double, frameshifts string")


_MATRIX = f"""{ALIGNMENTS}, own as (select * from alignments where not is_ref), best as (select sample, locus, arg_min(sequence, row(rank, seq_name)) as s from own group by 1, 2),
    grid as (select sample, locus, width from (select distinct sample from own), (select locus, max(length(sequence)) as width from own group by 1)),
    m as (select sample as name, string_agg(coalesce(s, repeat('-', width)), '' order by locus) as sequence from grid left join best using (sample, locus) group by 1)"""


def _matrix(spark, sf_dir):
    return site_ops.supermatrix(views.alignments(spark, sf_dir).where("not is_ref")).select(F.col("sample").alias("name"), "sequence")


@query("k03_nexus_lines", f"with {_MATRIX}, z as (select count(*) as n, max(length(sequence)) as w, max(length(name)) as p from m) select cast(100 as int) as ord, rpad(name, cast(p + 2 as int), ' ') || sequence as line from m, z union all select cast(2 as int), 'DIMENSIONS NTAX=' || n || ' NCHAR=' || w || ';' from z union all select unnest([0, 1, 3, 4, 200]), unnest(['#NEXUS', 'BEGIN DATA;', 'FORMAT DATATYPE=DNA MISSING=? GAP=-;', 'MATRIX', ';' || chr(10) || 'END;'])")
def nexus_lines(spark, sf_dir):
    return writers.nexus_lines(_matrix(spark, sf_dir)).select("ord", "line")


@query("k04_phylip_blocks", f"with {_MATRIX} select cast(b as int) as block, case when b = 0 then name || '  ' else '' end || substr(sequence, cast(b * 500 + 1 as bigint), 500) as line from (select *, unnest(range(0, (length(sequence) - 1) // 500 + 1)) as b from m)")
def phylip_blocks(spark, sf_dir):
    return writers.phylip_blocks(_matrix(spark, sf_dir), 500).select("block", "line")


@query("k05_partition_lines", f"with {ALIGNMENTS}, w as (select locus, max(length(sequence)) as width from alignments group by 1), o as (select locus, cast(sum(width) over (order by locus) as bigint) as e, width from w) select cast(row_number() over (order by e) as int) as ord, 'DNA, ' || locus || ' = ' || (e - width + 1) || '-' || e as line from o")
def partition_lines(spark, sf_dir):
    widths = views.alignments(spark, sf_dir).groupBy("locus").agg(F.max(F.length("sequence")).alias("width"))
    return writers.partition_lines(site_ops.partitions(widths))


@query("t01_incremental_ingest", f"with {EXTRACTION} select sample, locus, hit_id from extraction")
def incremental_ingest(spark, sf_dir):
    base = shared_folder(spark, "ingest")
    rows = views.extraction(spark, sf_dir).select("sample", "locus", "hit_id")
    early = F.col("sample").rlike("[02468]$")
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(f"{base}/in")
        ingest_new(spark, f"{base}/in", "sample string, locus string, hit_id long", f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("sample", "locus", "hit_id")
