"""Assemblies: contig filters, statistics and histograms per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq

#: Contig lengths whose shares are reported.
LENGTH_STEPS = (1000, 2000, 5000, 10000, 20000, 50000)


def parse_headers(frame: DataFrame, name: str = "name") -> DataFrame:
    """Contig names of two assembler styles as ``NODE_<i>_length_<L>_cov_<C>`` with columns length, depth, k."""
    c = F.col(name)
    short = r"^k(\d+)_(\d+) flag=(\d+) multi=([0-9.]+) len=(\d+)"
    part = lambda i: F.regexp_extract(c, short, i)
    made = F.concat(F.lit("NODE_"), part(2), F.lit("_length_"), part(5), F.lit("_cov_"), part(4), F.lit("_k_"), part(1), F.lit("_flag_"), part(3))
    frame = frame.withColumn("contig", F.when(c.rlike(short), made).otherwise(F.regexp_extract(c, r"^(\S+)", 1)))
    number = lambda key, kind: F.expr(f"try_cast(nullif(regexp_extract(contig, '_{key}_([0-9.]+)', 1), '') as {kind})")
    return frame.withColumns({"length": number("length", "int"), "depth": number("cov", "double"), "k": number("k", "int")})


#: Headers of the assemblers that are told apart.
NODE_STYLE = r"^(NODE|EDGE)_\d+_length_\d+_cov_\d+\.\d+"
FLAG_STYLE = r"^k\d{2,3}_\d+\sflag=\d\smulti=\d+\.\d+\slen=\d+$"
CONTIG_STYLE = r"^Contig_\d+_\d+\.\d+(_Circ)?$"


def normalise_headers(records: DataFrame, file: str = "src_file", order: str = "ord") -> DataFrame:
    """Contig names of every file as ``NODE_<i>_length_<L>_cov_<C>``, with what its assembler says besides, and the file's ``assembler``.

    A file's first record decides the style of all. Of ``k<K>_<i> flag=<F> multi=<C> len=<L>`` the name goes on with ``_k_<K>_flag_<F>``; of
    ``Contig_<i>_<C>`` the length is the sequence's, and ``_Circ`` becomes ``_circular``. Both lose their description; names and descriptions of
    other styles stay. ``records`` hold name, description, sequence, the file and the place in it.
    """
    c = F.col
    header = F.trim(F.concat_ws(" ", "name", F.coalesce("description", F.lit(""))))
    first = records.groupBy(file).agg(F.min_by(header, order).alias("h"))
    style = F.when(c("h").rlike(NODE_STYLE), "node").when(c("h").rlike(FLAG_STYLE), "flag").when(c("h").rlike(CONTIG_STYLE), "contig").otherwise("unknown")
    own = records.join(first.select(file, style.alias("assembler")), file).withColumn("__f", F.split(header, r"\s+|_"))
    field = lambda i: F.coalesce(F.get("__f", F.lit(i)), F.lit(""))
    value = lambda i: F.regexp_extract(field(i), r"=(.*)$", 1)
    flag = F.concat_ws("_", F.lit("NODE"), field(1), F.lit("length"), value(4), F.lit("cov"), value(3), F.lit("k"), F.substring(field(0), 2, 99), F.lit("flag"), value(2))
    contig = F.concat(F.concat_ws("_", F.lit("NODE"), field(1), F.lit("length"), F.length("sequence").cast("string"), F.lit("cov"), field(2)), F.when(F.array_contains(F.split("name", "_"), "Circ"), "_circular").otherwise(""))
    named = F.when(c("assembler") == "flag", flag).when(c("assembler") == "contig", contig).otherwise(c("name"))
    kept = F.when(c("assembler").isin("flag", "contig"), F.lit("")).otherwise(c("description"))
    return own.withColumns({"name": named, "description": kept}).drop("__f")


def file_kind(records: DataFrame, file: str = "src_file") -> DataFrame:
    """(file, kind): AA if a record of the file holds letters of proteins alone that nucleotides don't have, else NT."""
    kind = seq.sequence_kind(F.col("sequence"))
    return records.groupBy(file).agg(F.min(F.when(kind == "AA", "AA").otherwise("NT")).alias("kind"))


def mean_contig_depth(frame: DataFrame, keys: list[str], names: str = "contigs") -> DataFrame:
    """Mean depth over the distinct contigs that an array of names holds."""
    depths = F.transform(F.array_distinct(names), lambda n: F.expr("0D") + F.regexp_extract(n, "_cov_([0-9.]+)", 1).cast("double"))
    return frame.select(*keys, F.try_divide(F.aggregate(depths, F.lit(0.0), lambda a, x: a + x), F.size(depths)).alias("mean_depth"))


#: Least depth of a contig where none is given, with depths from mapped reads and without.
AUTO_DEPTH = {True: 1.5, False: 1.0001}


def filter_contigs(contigs: DataFrame, max_gc: float = 100.0, min_depth: float | None = None, mapped: bool = True) -> DataFrame:
    """Every contig with its GC percentage and whether it is accepted.

    Without ``min_depth`` it depends on whether depths come from mapped reads.
    """
    min_depth = AUTO_DEPTH[mapped] if min_depth is None else min_depth
    gc = F.round(F.coalesce(seq.gc_percent_strict(F.col("sequence")), F.lit(0.0)), 5)
    return contigs.withColumn("gc", gc).withColumn("accepted", (F.col("gc") <= max_gc) & (F.col("depth") >= min_depth))


def nx_lx(contigs: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.75, 0.9)) -> DataFrame:
    """Nx and Lx per group: the length at which the longest contigs reach a share of the total, and how many they are.

    Lengths are counted first, so that a group's window has one row a distinct length, not one a contig.
    """
    lengths = contigs.groupBy(*keys, "length").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(*keys).orderBy(F.desc("length"))
    whole = Window.partitionBy(*keys)
    run = lengths.withColumns({"upto": F.sum(F.col("n") * F.col("length")).over(down), "rank": F.sum("n").over(down), "total": F.sum(F.col("n") * F.col("length")).over(whole)})
    found = []
    for x in shares:
        reached = F.col("upto") >= F.col("total") * x
        missing = F.ceil(F.greatest(F.lit(0.0), F.col("total") * x - (F.col("upto") - F.col("n") * F.col("length"))) / F.greatest(F.col("length"), F.lit(1)))
        found += [F.max(F.when(reached, F.col("length"))).alias(f"n{round(100 * x)}"), F.min(F.when(reached, F.col("rank") - F.col("n") + F.greatest(missing, F.lit(1)))).alias(f"l{round(100 * x)}")]
    return run.groupBy(*keys).agg(*found)


def fragmentation(blocks: DataFrame, keys: list[str], reference: str, shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Nx, Lx of the blocks' ``length`` per group, and NGx, LGx against the length of its reference; 0 where that isn't reached."""
    own = nx_lx(blocks, keys, shares)
    down = Window.partitionBy(*keys).orderBy(F.desc("length"), F.desc("block"))
    run = blocks.select(*keys, "length", reference, F.struct("*").alias("block")).withColumns({"upto": F.sum("length").over(down), "n": F.row_number().over(down)})
    found = []
    for x in shares:
        reached = F.col("upto") >= F.col(reference) * x
        found += [F.coalesce(F.max(F.when(reached, F.col("length"))), F.lit(0)).alias(f"ng{round(100 * x)}"), F.coalesce(F.min(F.when(reached, F.col("n"))), F.lit(0)).alias(f"lg{round(100 * x)}")]
    return own.join(run.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_contigs"), *found), keys)


def assembly_stats(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers, lengths, GC, depth and shares of long contigs per group."""
    u = F.upper("sequence")
    over = lambda step: (F.col("length") >= step)
    aggregates = [
        F.count(F.lit(1)).alias("n_contigs"),
        F.sum("length").alias("total_length"),
        F.min("length").alias("shortest"),
        F.max("length").alias("longest"),
        F.round(F.avg("length"), 4).alias("mean_length"),
        F.expr("percentile(length, 0.5)").alias("median_length"),
        F.round(F.try_divide(100.0 * F.sum(seq.count_of(u, "GC")), F.sum(seq.count_of(u, "ACGT"))), 4).alias("gc"),
        F.round(F.avg("depth"), 4).alias("mean_depth"),
        F.expr("percentile(depth, 0.5)").alias("median_depth"),
    ]
    for step in LENGTH_STEPS:
        aggregates += [F.round(100.0 * F.count_if(over(step)) / F.count(F.lit(1)), 4).alias(f"pct_contigs_{step}"), F.round(F.try_divide(100.0 * F.sum(F.when(over(step), F.col("length")).otherwise(0)), F.sum("length")), 4).alias(f"pct_length_{step}")]
    return contigs.groupBy(*keys).agg(*aggregates)


def depth_bin(depth):
    """Upper edge of the histogram bin of a depth: steps of 0.5 to 5, 5 to 50, 50 to 500, 500 to 5000, then infinity."""
    step = lambda w: F.greatest(F.lit(1.0), F.ceil(depth / w).cast("double")) * w
    return F.when(depth <= 5, step(0.5)).when(depth <= 50, step(5.0)).when(depth <= 500, step(50.0)).when(depth <= 5000, step(500.0)).otherwise(F.lit(float("inf")))


def length_bin(length):
    """Upper edge of the histogram bin of a length: steps of 50 to 500, 500 to 5000, 5000 to 50000, then infinity."""
    step = lambda w: F.greatest(F.lit(1.0), F.ceil(length / w).cast("double")) * w
    return F.when(length <= 500, step(50.0)).when(length <= 5000, step(500.0)).when(length <= 50000, step(5000.0)).otherwise(F.lit(float("inf")))


def histogram(contigs: DataFrame, keys: list[str], bins, edges: list[float] | None = None) -> DataFrame:
    """Contigs and bases per bin and group, with the share of the group's bases; ``edges`` that are empty count 0."""
    counted = contigs.groupBy(*keys, bins.alias("bin")).agg(F.count(F.lit(1)).alias("n_contigs"), F.sum("length").alias("n_bases"))
    if edges is not None:
        grid = counted.select(*keys).distinct().withColumn("bin", F.explode(F.array(*map(F.lit, edges))))
        counted = grid.join(counted, [*keys, "bin"], "left").fillna(0, ["n_contigs", "n_bases"])
    total = F.sum("n_bases").over(Window.partitionBy(*keys))
    return counted.withColumn("fraction", F.round(F.coalesce(F.try_divide(F.col("n_bases"), total), F.lit(0.0)), 6))


def recomputed_depth(quant: DataFrame, read_length, paired: bool) -> DataFrame:
    """Depth of each contig from its number of reads, and the name that carries it."""
    depth = F.round(F.col("num_reads") * read_length * (2 if paired else 1) / F.col("length"), 4)
    return quant.withColumn("depth", depth)


def trim_to_populated(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Bins between the first and the last one that holds bases anywhere, with labels."""
    edge = bins.agg(F.min(F.when(F.col("n_bases") > 0, F.col("bin"))).alias("lo"), F.max(F.when(F.col("n_bases") > 0, F.col("bin"))).alias("hi"))
    lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
    return bins.where((F.col("bin") >= lo) & (F.col("bin") <= hi)).withColumn("label", F.concat(F.lit("≤"), F.col("bin").cast("long").cast("string")))
