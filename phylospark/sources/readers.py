"""Sequence, annotation, hit and statistics files as DataFrames; the readers are Spark's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators.assembly import file_kind, normalise_headers
from phylospark.operators.hits import parse_psl


def read_fasta(spark: SparkSession, paths: str | list[str], with_order: bool = False) -> DataFrame:
    """FASTA records: name, description, sequence, src_file, and their order (``ord``) on demand.

    Records end where a line begins with ``>``; files may be gzipped. Lines of a record are joined, records
    without residues are dropped, and of equal names in a file the last one stands.
    """
    # the whole-record separator makes each record one row, so large plain files split between records
    raw = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", "\r", "").alias("value"), F.col("_metadata.file_path").alias("src_file"), F.monotonically_increasing_id().alias("ord"))
    raw = raw.withColumn("value", F.regexp_replace("value", "^>", ""))
    head = F.regexp_extract("value", "^([^\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", "^[^\n]*", ""), r"\s", "")
    out = raw.select(F.regexp_extract(head, r"^(\S+)", 1).alias("name"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), body.alias("sequence"), "src_file", "ord").where((F.col("name") != "") & (F.col("sequence") != ""))
    last = out.groupBy("src_file", "name").agg(F.max_by(F.struct("description", "sequence"), "ord").alias("x"), F.min("ord").alias("ord"))
    return last.select("name", "x.description", "x.sequence", "src_file", *["ord"] * with_order)


def read_fastq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """FASTQ records: read_id, sequence, quality, src_file; four lines each, plain or gzipped.

    Large plain files are split. A line's number is its place in its split plus the lines of the file's
    earlier splits, from a table of one row a split (small against the lines, so it is broadcast); no sort.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    splits = lines.groupBy("src_file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = splits.withColumn("before", F.sum("n").over(Window.partitionBy("src_file").orderBy("block")) - F.col("n")).drop("n")
    numbered = lines.join(F.broadcast(before), ["src_file", "block"]).withColumn("no", F.col("place") - F.col("first") + F.col("before"))
    at = lambda k: F.max(F.when(F.col("no") % 4 == k, F.regexp_replace("value", "\r", "")))
    records = numbered.groupBy("src_file", F.floor(F.col("no") / 4).alias("record")).agg(at(0).alias("head"), at(1).alias("sequence"), at(3).alias("quality"))
    return records.where(F.col("quality").isNotNull()).select(F.regexp_extract("head", r"^@(\S+)", 1).alias("read_id"), "sequence", "quality", "src_file")


def pair_files(files: DataFrame, path: str = "path") -> DataFrame:
    """R1 files with their mates: sample, r1, r2 (null: single-end). Names with ``__`` and lone R2 files don't count."""
    name = F.element_at(F.split(path, "/"), -1)
    own = files.select(F.col(path).alias("p"), name.alias("name"), F.regexp_replace(path, r"[^/]*$", "").alias("dir")).where(~F.col("name").contains("__"))
    first = own.where(F.col("name").rlike(r"_R1[._]")).withColumn("mate", F.regexp_replace("name", r"_R1([._])", "_R2$1"))
    second = own.select("dir", F.col("name").alias("mate"), F.col("p").alias("r2"))
    return first.join(second, ["dir", "mate"], "left").select(F.regexp_extract("name", r"^(.*?)_R1[._]", 1).alias("sample"), F.col("p").alias("r1"), "r2")


def match_annotations(fastas: DataFrame, gffs: DataFrame, path: str = "path") -> DataFrame:
    """FASTA files with the GFF file of the same stem, if there is one."""
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.(fa|fas|fasta|fna|gff|gff3)(\.gz)?$", "")
    return fastas.select(stem(path).alias("stem"), F.col(path).alias("fasta")).join(gffs.select(stem(path).alias("stem"), F.col(path).alias("gff")), "stem", "left")


def read_gff_cds(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CDS rows of GFF files: seq_id, start, end, strand, shift (phase, ``.`` is 0), cds_id (protein_id, else parent)."""
    cols = "seq_id string, source string, kind string, start int, end int, score string, strand string, phase string, attributes string"
    rows = spark.read.schema(cols).option("sep", "\t").option("comment", "#").csv(paths).where(F.lower("kind") == "cds")
    keys = F.map_from_entries(F.transform(F.filter(F.split("attributes", ";"), lambda x: x.contains("=")), lambda x: F.struct(F.lower(F.trim(F.split(x, "=")[0])), F.split(x, "=")[1])))
    rows = rows.withColumn("a", keys)
    return rows.select("seq_id", "start", "end", "strand", F.coalesce(F.expr("try_cast(phase as int)"), F.lit(0)).alias("shift"), F.coalesce(F.try_element_at("a", F.lit("protein_id")), F.try_element_at("a", F.lit("parent"))).alias("cds_id"))


def read_psl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_psl(spark.read.text(paths))


def read_table(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Tab-separated statistics with ``#`` comments, a header, and NA for null."""
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").option("header", True).option("nullValue", "NA").csv(paths)


def exon_shares(exons: DataFrame) -> DataFrame:
    """Shares of long and short exons of a gene's length; 0 where the length is 0."""
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("gene_len")), F.lit(0.0))
    return exons.withColumns({"prop_long_exons": share("long_exons_len"), "prop_short_exons": share("short_exons_len")})


def read_quant(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    rows = spark.read.schema("contig string, length int, effective_length double, tpm double, num_reads double").option("sep", "\t").option("header", True).csv(paths)
    return rows.select("contig", "length", "num_reads")


def read_clusters(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema("centroid string, member string").option("sep", "\t").csv(paths).dropDuplicates()


def read_sam(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Name, CIGAR and sequence of SAM records."""
    f = F.split("value", "\t")
    return spark.read.text(paths).where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(f[0].alias("name"), f[5].alias("cigar"), f[9].alias("sequence"))


def unclipped(sam: DataFrame) -> DataFrame:
    """Mapped records without soft clips."""
    return sam.where((F.col("cigar") != "*") & ~F.col("cigar").contains("S"))


def sample_of(src_file: str = "src_file", suffix: str = "__ext"):
    """Sample from a file's directory, without the directory's suffix; null where the name still holds the separator."""
    name = F.regexp_replace(F.element_at(F.split(src_file, "/"), -2), f"{suffix}$", "")
    return F.when(~name.contains("__"), name)


def import_assembly(records: DataFrame) -> DataFrame:
    """Nucleotide records only, U as T."""
    return records.where(seq.sequence_kind(F.col("sequence")) == "NT").withColumn("sequence", F.translate(F.col("sequence"), "Uu", "Tt"))


def import_assemblies(records: DataFrame, order: str = "ord") -> DataFrame:
    """Records of the files that hold nucleotides, U as T, under normalised names; see ``normalise_headers``."""
    nt = file_kind(records).where("kind = 'NT'").select("src_file")
    own = records.join(nt, "src_file", "left_semi").withColumn("sequence", F.translate(F.col("sequence"), "Uu", "Tt"))
    return normalise_headers(own, "src_file", order)


def import_orthologs(records: DataFrame) -> DataFrame:
    """Names get the part before their first underscore as locus: ``name-prefix``."""
    return records.withColumn("name", F.concat_ws("-", "name", F.split_part("name", F.lit("_"), F.lit(1))))


def reference_targets(records: DataFrame, code: int = 1) -> DataFrame:
    """Targets with locus, kind and protein form: nucleotides are translated in their best frame, inner stops are X."""
    kind = seq.sequence_kind(F.col("sequence"))
    # only the names of files of amino acids meet the records, so a large file isn't one task
    files = records.groupBy(F.col("src_file").alias("__file")).agg(F.min(kind).alias("__least")).where("__least = 'AA'")
    per = records.join(F.broadcast(files), F.col("src_file").eqNullSafe(F.col("__file")), "left").withColumn("kind", F.when(F.col("__least") == "AA", "AA").otherwise(kind))
    protein = F.when(F.col("kind") == "NT", seq.best_frame(F.col("sequence"), code).aa).otherwise(F.upper("sequence"))
    return per.select(F.col("name").alias("target"), F.element_at(F.split("name", "-"), -1).alias("locus"), F.col("kind").alias("seq_type"), "sequence", seq.mask_premature_stops(protein).alias("protein"))


def _strand_exons(cds: DataFrame, genome: DataFrame) -> DataFrame:
    """Per CDS its exons in strand order, cut from the genome; of CDS with equal places the first id stays.

    The first exon in strand order begins after the bases of its phase; places are those of the annotation.
    """
    own = cds.groupBy("cds_id", "seq_id", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end", "shift"))).alias("exons"))
    minus = F.col("strand") == "-"
    own = own.withColumn("exons", F.when(minus, F.reverse("exons")).otherwise(F.col("exons")))
    places = F.array_join(F.transform("exons", lambda e: F.concat_ws("-", e.start.cast("string"), e.end.cast("string"))), ",")
    own = own.withColumn("description", F.concat(F.lit("["), "seq_id", F.lit(":"), places, F.lit(":"), "strand", F.lit("]")))
    own = own.groupBy("description").agg(F.min_by(F.struct("cds_id", "seq_id", "strand", "exons"), "cds_id").alias("x")).select("description", "x.*")

    def piece(e, i):
        off = F.when(i == 0, e.shift).otherwise(0)
        text = F.substring(F.col("sequence"), e.start + F.when(minus, 0).otherwise(off), e.end - e.start + 1 - off)
        return F.struct(e.start.alias("start"), e.end.alias("end"), F.when(minus, seq.reverse_complement(text)).otherwise(text).alias("s"))

    return own.join(genome.select(F.col("name").alias("seq_id"), "sequence"), "seq_id").withColumn("exons", F.transform("exons", piece)).drop("sequence")


def read_cds_exons(cds: DataFrame, genome: DataFrame, bait_length: int = 120) -> DataFrame:
    """Per CDS: joined exon sequence in strand order, numbers and lengths of long and short exons, introns and gene."""
    own = _strand_exons(cds, genome)
    size = lambda e: F.length(e.s)
    total = lambda cond: F.aggregate(F.filter("exons", cond), F.lit(0), lambda a, e: a + size(e))
    long_, short = (lambda e: size(e) >= bait_length), (lambda e: size(e) < bait_length)
    first, last = F.element_at("exons", 1), F.element_at("exons", -1)
    gene = F.when(F.col("strand") == "-", first.end - last.start + 1).otherwise(last.end - first.start + 1)
    return own.select("cds_id", "seq_id", "strand", "description", F.array_join(F.transform("exons", lambda e: e.s), "").alias("sequence"), F.size("exons").alias("exons"), F.size(F.filter("exons", long_)).alias("long_exons"), total(long_).alias("long_exons_len"), F.size(F.filter("exons", short)).alias("short_exons"), total(short).alias("short_exons_len"), gene.alias("gene_len"), (gene - F.aggregate("exons", F.lit(0), lambda a, e: a + size(e))).alias("introns_len"))


def split_exons(cds: DataFrame, genome: DataFrame, bait_length: int = 120) -> DataFrame:
    """A row an exon: its name by CDS and number in strand order, its places, sequence, and whether a bait fits it."""
    flat = _strand_exons(cds, genome).select("cds_id", "seq_id", "strand", F.posexplode("exons").alias("n", "x"))
    places = F.concat(F.lit("["), "seq_id", F.lit(":"), F.col("x.start").cast("string"), F.lit("-"), F.col("x.end").cast("string"), F.lit(":"), "strand", F.lit("]"))
    return flat.select(F.concat(F.col("cds_id"), F.lit("_exon"), (F.col("n") + 1).cast("string")).alias("name"), places.alias("description"), F.col("x.s").alias("sequence"), (F.length("x.s") >= bait_length).alias("long"))
