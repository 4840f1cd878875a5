"""Tables of many samples brought together, small projections of them, and curated clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq

from . import sites
from .hits import gff_lines

#: The largest contigs of organelle genomes, by marker.
MAX_ORGANELLE = {"PTD": 550_000, "MIT": 1_000_000}
#: The stage and formats of alignments whose connecting ``n`` are residues.
CODING_FORMATS = ("AA", "NT")


def merge_tables(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables under one set of columns; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def prefix_samples(records: DataFrame, sample: str = "sample", name: str = "name", sep: str = "__") -> DataFrame:
    """Names that begin with their sample, so that records of all samples fit in one table."""
    return records.withColumn(name, F.concat_ws(sep, sample, name))


def cap_organelles(contigs: DataFrame, marker: str = "marker", length: str = "length") -> DataFrame:
    """Contigs of organelle markers no longer than the largest such genome; other markers keep all."""
    cap = F.create_map(*[F.lit(x) for pair in MAX_ORGANELLE.items() for x in pair])
    return contigs.where(F.coalesce(F.col(length) <= F.try_element_at(cap, F.col(marker)), F.lit(True)))


def fix_residues(sequence: Column, kind: Column) -> Column:
    """Connecting ``n`` as gaps outside coding formats, stops as X in proteins."""
    return F.when(kind == "AA", F.translate(sequence, "*", "X")).when(~kind.isin(*CODING_FORMATS), F.translate(sequence, "n", "-")).otherwise(sequence)


def sample_list(names: str | None, species: bool = True) -> list[str]:
    """Distinct entries of a comma list, of each its first two parts if species are meant."""
    found = [n for n in (names or "").split(",") if n]
    return sorted({"_".join(n.split("_")[:2]) if species else n for n in found})


def without_samples(rows: DataFrame, exclude: DataFrame, retain: DataFrame | None = None, sample: str = "sample") -> DataFrame:
    """Rows of samples that aren't excluded, or that are retained all the same."""
    out = exclude if retain is None else exclude.join(retain, sample, "left_anti")
    return rows.join(out, sample, "left_anti")


def outgroup_first(aln: DataFrame, outgroup: DataFrame, keys: list[str], original: DataFrame) -> DataFrame:
    """Place of every row: outgroups in the order of their list, then the rest by name.

    ``outgroup`` has sample and rank. A leading ``_R_`` goes from names; descriptions come from the ``original``.
    """
    clean = aln.withColumn("seq_name", F.regexp_replace("seq_name", "^_R_", ""))
    named = clean.join(outgroup, "sample", "left").join(original.select(*keys, "seq_name", "description"), [*keys, "seq_name"], "left")
    w = Window.partitionBy(*keys).orderBy(F.col("rank").asc_nulls_last(), "seq_name")
    return named.withColumn("place", F.row_number().over(w)).select(*keys, "place", "seq_name", "description")


def stage_key(trimmed: Column, filter_: Column, with_refs: Column) -> Column:
    """``trimmed-filter-refs`` of an alignment's stage."""
    return F.concat_ws("-", F.when(trimmed, "trimmed").otherwise("untrimmed"), filter_, F.when(with_refs, "w_refs").otherwise("no_refs"))


def split_path(frame: DataFrame, path: str = "path") -> DataFrame:
    """Stage, filter, marker and format from a name that joins them by `` / ``."""
    parts = F.split(path, " / ")
    return frame.withColumns({name: F.get(parts, i) for i, name in enumerate(("stage", "filter", "marker", "format"))})


def assembly_summary(stats: DataFrame) -> DataFrame:
    """What a report shows of finished assemblies, under its headings."""
    names = {"sample": "Sample", "n_contigs": "#Contigs", "total_length": "Total Length (bp)", "shortest": "Shortest Contig (bp)", "longest": "Longest Contig (bp)", "n50": "N50 (bp)", "l50": "L50", "gc": "GC Content (%)", "mean_depth": "Mean Depth (x)"}
    return stats.where("stage = 'after'").select(*[F.col(c).alias(n) for c, n in names.items()])


def populated_percentage(levels: DataFrame) -> DataFrame:
    """One column of percentages: of the total, or of deduplicated reads where the whole table has none."""
    some = levels.agg(F.count("percentage_of_total").alias("n")).scalar()
    chosen = F.when(some > 0, F.col("percentage_of_total")).otherwise(F.col("percentage_of_deduplicated"))
    return levels.withColumn("percentage_of_total", chosen).drop("percentage_of_deduplicated")


def annotated_assembly(contigs: DataFrame, hits: DataFrame) -> DataFrame:
    """All contigs with their numbers of hits and loci, marked as hit or leftover."""
    found = hits.groupBy("sample", "contig").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("locus").alias("loci"))
    out = contigs.join(found, ["sample", "contig"], "left").fillna(0, ["hits", "loci"])
    return out.withColumn("part", F.when(F.col("hits") > 0, "hit").otherwise("leftover"))


def merged_annotation(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, statistics) of all markers' hits of a sample: GFF lines with the contig and place to order them by, and a row a marker."""
    own = hits.withColumn("sample", F.struct("sample", "marker", F.col("contig").cast("string").alias("contig"), F.least("t_start", "t_end").alias("start")))
    lines = gff_lines(own).select("sample.*", "line")
    stats = hits.groupBy("sample", "marker").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("locus").alias("loci"), F.count_distinct("contig").alias("contigs"), F.sum(F.abs(F.col("t_end") - F.col("t_start"))).alias("bases"))
    return lines, stats


def read_funnel(stages: DataFrame, order: list[str]) -> DataFrame:
    """Reads and bases of each sample after each stage, with what the stage took from the one before, a row a sample."""
    out = stages.groupBy("sample")
    made = [F.max(F.when(F.col("stage") == s, F.col(c))).alias(f"{c}_{s}") for s in order for c in ("reads", "bases")]
    wide = out.agg(*made)
    lost = {f"pct_{c}_lost_{b}": F.round(F.coalesce(F.try_divide(100.0 * (F.col(f"{c}_{a}") - F.col(f"{c}_{b}")), F.col(f"{c}_{a}")), F.lit(0.0)), 4) for a, b in zip(order, order[1:], strict=False) for c in ("reads", "bases")}
    return wide.withColumns(lost)


def exons_of(exons: DataFrame, chosen: DataFrame, min_length: int) -> DataFrame:
    """Long exons of the chosen coding sequences."""
    return exons.where(F.col("length") >= min_length).join(chosen.select("cds_id").distinct(), "cds_id", "left_semi")


def coding_loci(seqs: DataFrame, cds: DataFrame, name: str = "name") -> DataFrame:
    """Whether any sequence of a locus is a known coding sequence."""
    known = cds.select(F.col("cds_id").alias(name)).distinct().withColumn("known", F.lit(True))
    return seqs.join(known, name, "left").groupBy("locus").agg(F.coalesce(F.max("known"), F.lit(False)).alias("coding"))


def union_baits(coding: DataFrame, noncoding: DataFrame) -> DataFrame:
    """Baits of coding and of other loci together, told apart by ``coding``."""
    return coding.withColumn("coding", F.lit(True)).unionByName(noncoding.withColumn("coding", F.lit(False)))


def locus_data(members: DataFrame, centroids: DataFrame) -> DataFrame:
    """Per locus over its chosen centroids: sequences, samples, median copies of a sample, loci included."""
    own = members.join(centroids.select("locus_name", "centroid"), "centroid")
    per = own.groupBy("locus_name", "sample").agg(F.count(F.lit(1)).alias("c"), F.collect_set("locus").alias("held"))
    out = per.groupBy("locus_name").agg(F.sum("c").alias("num_seqs"), F.count(F.lit(1)).alias("num_samples"), F.expr("percentile(c, 0.5)").alias("median_copies"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("held")))), ",").alias("includes"))
    return out


def new_targets(data: DataFrame) -> DataFrame:
    """Names and descriptions of a new target file: ``__`` becomes ``_H`` in names."""
    text = F.concat(F.lit("[copies="), F.col("median_copies").cast("string"), F.lit("] [samples="), F.col("num_samples").cast("string"), F.lit("] [seqs="), F.col("num_seqs").cast("string"), F.lit("]"))
    return data.select(F.concat_ws("-", F.regexp_replace("member", "__", "_H"), "locus_name").alias("name"), text.alias("description"))


def retained_exons(lengths: DataFrame, exons: DataFrame, keys: list[str]) -> DataFrame:
    """Per alignment the coding sequence of median retained length (the lower of two) and its exons' retained shares."""
    order = F.struct("retained", "cds_id")
    ranked = lengths.withColumns({"place": F.row_number().over(Window.partitionBy(*keys).orderBy(order)), "n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    middle = ranked.where(F.col("place") == F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    own = middle.join(exons, "cds_id")
    share = F.try_divide(F.col("retained"), F.col("exons_len"))
    long_ = F.col("prop_long_exons") * share
    return own.select(*keys, "cds_id", F.round(100.0 * share, 2).alias("perc_exons_retained"), F.round(100.0 * long_, 2).alias("perc_long_exons_retained"), F.round(long_ * F.col("exons_len"), 0).alias("len_long_exons_retained"))


def curated_rows(aln: DataFrame, addons: DataFrame, keys: list[str], bait_length: int = 120, gaps: float = 0.2) -> DataFrame:
    """Rows of clusters cut to their well-filled middle, those of a bait's length and more."""
    cut = sites.trim_by_depth(aln, keys, gaps, addons)
    return cut.where(F.length(F.regexp_replace("sequence", "-", "")) >= bait_length)


def curate_clusters(aln: DataFrame, focal: DataFrame, outgroup: DataFrame, addons: DataFrame, keys: list[str], bait_length: int = 120, gaps: float = 0.2) -> DataFrame:
    """Width and rows of curated clusters (``curated_rows``), with counts of who is in them."""
    rows = curated_rows(aln, addons, keys, bait_length, gaps)
    flag = lambda frame, name: frame.select("sample").distinct().withColumn(name, F.lit(True))
    own = rows.join(flag(focal, "focal"), "sample", "left").join(flag(outgroup, "outgroup"), "sample", "left").join(flag(addons, "addon"), "sample", "left")
    of = lambda c: F.count_distinct(F.when(F.col(c), F.col("sample"))).alias(c)
    return own.groupBy(*keys).agg(F.max(F.length("sequence")).alias("width"), F.count(F.lit(1)).alias("rows"), F.count_distinct("sample").alias("samples"), of("focal"), of("outgroup"), of("addon"))


def trim_codons_with_protein(aa: DataFrame, nt: DataFrame, keys: list[str], gaps: float = 0.9, mask: str = "?") -> DataFrame:
    """Codon alignments cut as their proteins are: the columns that the protein loses go three by three, so do its
    rows, and a masked residue is three gaps."""
    kept = sites.kept_columns(aa, keys, "gappy", gaps, kind="AA")
    rows = nt.select(*keys, "seq_name", F.col("sequence").alias("nt")).join(aa.select(*keys, "seq_name", F.col("sequence").alias("aa")), [*keys, "seq_name"]).join(kept, keys)
    codon = lambda s, letters, p: F.when(F.get(letters, p) == mask, "---").otherwise(F.get(s, p))
    cut = F.struct(F.regexp_extract_all("nt", F.lit("..."), F.lit(0)).alias("c"), F.split("aa", "").alias("a"))
    text = F.transform(F.array(cut), lambda x: F.array_join(F.transform(F.array_sort("kept"), lambda p: codon(x.c, x.a, p)), ""))
    return rows.select(*keys, "seq_name", F.element_at(text, 1).alias("sequence"))


def densify(counts: DataFrame, keys: list[str], axes: list[str], value: str = "n") -> DataFrame:
    """A row for every pair of values of two axes that occur in a group, 0 where there was none."""
    of = lambda c: counts.select(*keys, c).distinct()
    return of(axes[0]).join(of(axes[1]), keys).join(counts, [*keys, *axes], "left").fillna(0, [value])


def file_statistics(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Alignment statistics of every file, by the kind of its residues; GC by codon place only for coding files."""
    kind = aln.groupBy(*keys).agg(F.min(F.when(seq.sequence_kind(F.col("sequence")) == "NT", 1).otherwise(0)).alias("is_nt"))
    own = aln.join(kind, keys)
    nt, aa = own.where("is_nt = 1").drop("is_nt"), own.where("is_nt = 0").drop("is_nt")
    coding = sites.gc_by_codon(nt.where("format = 'NT'"), keys)
    stats = sites.alignment_stats(nt, keys, "NT").withColumn("kind", F.lit("NT")).join(coding, keys, "left")
    return stats.unionByName(sites.alignment_stats(aa, keys, "AA").withColumn("kind", F.lit("AA")), allowMissingColumns=True)


def reference_candidates(clusters: DataFrame, single: bool = True, min_samples: int = 4) -> DataFrame:
    """Centroids that may stand as references, by samples and length; the first of a locus, or all."""
    per = clusters.groupBy("centroid").agg(F.count_distinct("sample").alias("samples"), F.max("length").alias("longest"), F.min(F.when(F.col("member") == F.col("centroid"), F.col("locus"))).alias("locus"))
    ranked = per.where(F.col("samples") >= min_samples).withColumn("place", F.row_number().over(Window.partitionBy("locus").orderBy(F.desc("samples"), F.desc("longest"), "centroid")))
    return ranked.where("place = 1") if single else ranked


def target_set(clusters: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Centroids that stand for their locus: no other locus in their cluster, and a share of the locus's longest member."""
    lead = clusters.where(F.col("member") == F.col("centroid")).select("centroid", F.col("locus").alias("own"), F.col("length").alias("centroid_length"))
    met = clusters.join(lead, "centroid")
    pure = met.groupBy("centroid", "own", "centroid_length").agg(F.max(F.when(F.col("locus") != F.col("own"), 1).otherwise(0)).alias("mixed"))
    longest = clusters.groupBy(F.col("locus").alias("own")).agg(F.max("length").alias("longest"))
    out = pure.join(longest, "own").where((F.col("mixed") == 0) & (F.col("centroid_length") >= min_share * F.col("longest")))
    return out.select("centroid", F.col("own").alias("locus"), "centroid_length", F.round(F.col("centroid_length") / F.col("longest"), 4).alias("coverage"))


def copy_loci(rows: DataFrame, selected: DataFrame, dry: bool = False) -> DataFrame:
    """Rows of the selected loci; on a dry run only how many each would have."""
    out = rows.join(selected.select("locus").distinct(), "locus", "left_semi")
    return out.groupBy("locus").agg(F.count(F.lit(1)).alias("rows")) if dry else out
