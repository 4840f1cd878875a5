"""Similarity hits: scores, ranks, overlaps, paralogs and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tolerances and defaults of hit filters.
LENGTH_TOLERANCE = 0.1
FLANK = 1000
MAX_INSERT_SHARE, MAX_INSERT = 0.2, 200
PARALOG_IDENTITY, PARALOG_COVERAGE, PARALOG_DEPTH = 0.66, 0.33, 0.33
MIN_SCORE, SCORE_SHARE = 0.001, 0.02
#: Width of the position bins by which overlapping hits meet.
BIN = 50_000


def parse_psl(lines: DataFrame, column: str = "value") -> DataFrame:
    """Hit records of 21 or more fields; lines of fewer fields or with texts for numbers are dropped."""
    f = F.split(F.trim(F.col(column)), r"\s+")
    names = ["matches", "mismatches", "rep_matches", "n_count", "q_num_insert", "q_base_insert", "t_num_insert", "t_base_insert"]
    number = lambda i: F.expr(f"try_cast(f[{i}] as int)")
    ints = lambda i: F.expr(f"transform(filter(split(f[{i}], ','), x -> x <> ''), x -> try_cast(x as int))")
    out = lines.select(f.alias("f")).where(F.size("f") >= 21)
    out = out.select(
        *[number(i).alias(n) for i, n in enumerate(names)],
        F.col("f")[8].alias("strand"),
        F.col("f")[9].alias("q_name"),
        *[number(i).alias(n) for i, n in zip((10, 11, 12), ("q_size", "q_start", "q_end"), strict=True)],
        F.col("f")[13].alias("t_name"),
        *[number(i).alias(n) for i, n in zip((14, 15, 16, 17), ("t_size", "t_start", "t_end", "block_count"), strict=True)],
        *[ints(i).alias(n) for i, n in zip((18, 19, 20), ("block_sizes", "q_starts", "t_starts"), strict=True)],
        F.expr("try_cast(try_element_at(f, 22) as double)").alias("wscore"),
    )
    return out.where(F.col("matches").isNotNull() & F.col("t_end").isNotNull() & F.col("block_count").isNotNull())


def hit_identity(matches: Column, mismatches: Column, inserts: Column, q_span: Column, t_span: Column, rep_matches: Column | int = 0, size: int = 1) -> Column:
    """Identity in percent after the milli-bad rule: mismatches, query inserts and a log of the size difference count."""
    q = size * q_span
    total = size * (matches + mismatches + rep_matches)
    penalty = F.floor(3 * F.log(1 + F.abs(q - t_span)) + 0.5)
    bad = F.when(total != 0, 1000.0 * (mismatches * size + inserts + penalty) / total).otherwise(0.0)
    return F.when(F.least(q, t_span) <= 0, 0.0).otherwise(100.0 - bad * 0.1)


def prefilter_score(matches: Column, mismatches: Column, inserts: Column, q_size: Column) -> Column:
    """Share of the query that matches, times its matches less the bad ones."""
    return F.try_divide(matches - mismatches - inserts, q_size) * F.try_divide(matches + mismatches, q_size)


def weighted_score(identity: Column, coverage: Column, contigs: Column | int = 1, frameshifts: Column | int = 0) -> Column:
    """identity^2 * sqrt(coverage), a little less for each further contig and each frameshift; inputs in percent."""
    one = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.pow(identity / 100, F.lit(2)) * F.sqrt(coverage / 100) * F.pow(F.lit(0.999), one(contigs) - 1) * F.pow(F.lit(0.975), one(frameshifts))


def hit_region(q_size: Column, q_start: Column, q_end: Column, t_size: Column, t_start: Column, t_end: Column, strand: Column, tolerance: float = LENGTH_TOLERANCE) -> Column:
    """Where a hit lies on its query: full, proximal, middle, distal, or wedged between unmatched flanks.

    A flank counts against a partial hit when it is *under* the tolerance, as the documented rule has it.
    """
    lead, tail, edge, span = q_start, q_size - q_end, q_size * tolerance, t_end - t_start
    region = F.when((q_end - q_start >= q_size * (1 - tolerance)) | ((lead < edge) & (tail < edge)), "full").when((lead >= edge) & (tail >= edge), "middle").when(lead <= edge, "proximal").when(tail <= edge, "distal").otherwise("wedged")
    left, right = F.try_divide(t_start, span) < tolerance, F.try_divide(t_size - t_end, span) < tolerance
    plus = strand == "+"
    bad_right = ((region == "proximal") & plus) | ((region == "distal") & ~plus)
    bad_left = ((region == "proximal") & ~plus) | ((region == "distal") & plus)
    wedged = ((region == "middle") & (left | right)) | (bad_right & right) | (bad_left & left)
    return F.when(wedged, "wedged").otherwise(region)


def merge_blocks(sizes: Column, starts: Column, limit: Column) -> Column:
    """Adjacent blocks joined where the gap on the target is under ``limit``: array of (s, e)."""
    blocks = F.zip_with(starts, sizes, lambda s, n: F.struct(s.alias("s"), (s + n).alias("e")))
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def step(acc: Column, b: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last.s.alias("s"), b.e.alias("e"))))
        return F.when((F.size(acc) > 0) & (b.s - F.try_element_at(acc, F.lit(-1)).e < limit), joined).otherwise(F.concat(acc, F.array(b)))

    def safe(acc: Column, b: Column) -> Column:
        return F.when(F.size(acc) == 0, F.array(b)).otherwise(step(acc, b))

    return F.aggregate(blocks, empty, safe)


def psl_blocks(sizes: Column, q_starts: Column, t_starts: Column, q_size: Column, strand: Column) -> Column:
    """Blocks of a PSL record, joined over gaps on the contig that are shorter than a fifth of the query and 200: arrays ``q`` and ``t`` of (s, e).

    On the minus strand the query's blocks are counted from its beginning, so they come in the other order.
    """
    limit = F.least(q_size * MAX_INSERT_SHARE, F.lit(float(MAX_INSERT)))
    n = F.size(sizes)
    at = lambda a, i: F.element_at(a, i + 1).cast("long")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    opens = F.filter(places, lambda i: (i == 0) | (at(t_starts, i) - at(t_starts, F.greatest(i - 1, F.lit(0))) - at(sizes, F.greatest(i - 1, F.lit(0))) >= limit))
    closes = F.concat(F.transform(F.slice(opens, F.lit(2), F.greatest(F.size(opens) - 1, F.lit(0))), lambda i: i - 1), F.slice(places, F.greatest(n, F.lit(1)), F.lit(1)))
    spans = lambda starts: F.zip_with(opens, closes, lambda i, j: F.struct(at(starts, i).alias("s"), (at(starts, j) + at(sizes, j)).alias("e")))
    turned = F.reverse(F.transform(spans(q_starts), lambda b: F.struct((q_size - b.e).cast("long").alias("s"), (q_size - b.s).cast("long").alias("e"))))
    return F.struct(F.when(strand == "-", turned).otherwise(spans(q_starts)).alias("q"), spans(t_starts).alias("t"))


def format_coordinates(blocks: Column) -> Column:
    """Half-open 0-based blocks as ``first-last`` text, 1-based."""
    return F.array_join(F.transform(blocks, lambda b: F.concat((b.s + 1).cast("string"), F.lit("-"), b.e.cast("string"))), ",")


def overlap(a: Column, b: Column) -> Column:
    """Bases that two arrays of blocks share."""
    return F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + F.aggregate(b, F.lit(0).cast("long"), lambda c, y: c + F.greatest(F.lit(0), F.least(x.e, y.e) - F.greatest(x.s, y.s)).cast("long")))


def overlap_kinds(a: Column, b: Column) -> Column:
    """For each pair of blocks of two hits N (apart), F (one inside the other) or P (partly shared)."""
    kind = lambda x, y: F.when((x.s >= y.e) | (y.s >= x.e), "N").when(((y.s <= x.s) & (y.e >= x.e)) | ((x.s <= y.s) & (x.e >= y.e)), "F").otherwise("P")
    apart = (F.element_at(a, -1).e <= F.element_at(b, 1).s) | (F.element_at(b, -1).e <= F.element_at(a, 1).s)
    return F.when(apart, "N").otherwise(F.array_join(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: kind(x, y)))), ","))


def overlap_percent(a: Column, b: Column, a_length: Column, b_length: Column) -> Column:
    """Bases that two hits share as a percentage of the longer hit."""
    return F.try_divide(100.0 * overlap(a, b), F.greatest(a_length, b_length))


def extract_blocks(sequence: Column, blocks: Column, flank: int = FLANK) -> Column:
    """Matched blocks in upper case with what lies between and beside them in lower case."""
    first, last = F.element_at(blocks, 1).s, F.element_at(blocks, -1).e
    left = F.lower(F.substring(sequence, F.greatest(first - flank, F.lit(0)) + 1, F.least(first, F.lit(flank))))
    right = F.lower(F.substring(sequence, last + 1, F.lit(flank)))
    inner = F.transform(blocks, lambda b, i: F.concat(F.when(i > 0, F.lower(F.substring(sequence, F.element_at(blocks, F.greatest(i, F.lit(1))).e + 1, b.s - F.element_at(blocks, F.greatest(i, F.lit(1))).e))).otherwise(F.lit("")), F.upper(F.substring(sequence, b.s + 1, b.e - b.s))))
    return F.concat(left, F.array_join(inner, ""), right)


def drop_weak_targets(hits: DataFrame, keys: list[str], least: float = MIN_SCORE, share: float = SCORE_SHARE) -> DataFrame:
    """Hits that reach both a fixed score and a share of their target's best."""
    best = hits.groupBy(*keys, "target").agg(F.max("wscore").alias("best"))
    return hits.join(best, [*keys, "target"]).where(F.col("wscore") >= F.greatest(F.lit(least), F.lit(share) * F.col("best"))).drop("best")


def top_targets(hits: DataFrame, keys: list[str], n: int = 100) -> DataFrame:
    """Hits of each locus's ``n`` targets of highest score."""
    best = hits.groupBy(*keys, "target").agg(F.max("wscore").alias("best"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("best"), "target"))
    return hits.join(best.withColumn("r", rank).where(F.col("r") <= n).select(*keys, "target"), [*keys, "target"], "left_semi")


#: Targets of a locus after the first and the final round, a chromosome's least size, and comparisons across loci at most.
TARGETS_FIRST, TARGETS_FINAL, CHROMOSOME, COMPARISONS = 7, 100, 10_000_000, 400_000_000


def target_numbers(hits: DataFrame, group: list[str], first_round: bool, budget: int = COMPARISONS, chromosome: int = CHROMOSOME) -> DataFrame:
    """How many targets a locus may keep in each group of hits (``best_n``; null: all).

    The number is limited in the first round, and wherever all targets against one another exceed the ``budget``. In the first round
    within it the limit is the small number, else the large one; contigs of a chromosome's size halve the one and leave a tenth of the
    other. The large one is lowered, to one at least, until all loci's targets against those of the other loci meet the budget.
    """
    c = F.col
    own = hits.groupBy(*group).agg(F.count_distinct("locus", "target").alias("t"), F.count_distinct("locus").alias("loci"), F.max("t_size").alias("largest"))
    within, large = c("t") * (c("t") - 1) < budget, c("largest") >= chromosome
    small = F.when(large, max(1, TARGETS_FIRST // 2)).otherwise(TARGETS_FIRST)
    most = F.when(large, TARGETS_FINAL // 10).otherwise(TARGETS_FINAL)
    fits = F.filter(F.sequence(F.lit(2).cast("long"), F.greatest(most.cast("long"), F.lit(2).cast("long"))), lambda n: c("loci") * (c("loci") - 1) * n * n <= budget)
    lowered = F.least(most, F.coalesce(F.array_max(fits), F.lit(1)))
    limited = F.lit(first_round) | (c("t") * (c("t") - 1) > budget)
    return own.select(*group, F.when(limited, F.when(F.lit(first_round) & within, small).otherwise(lowered)).cast("int").alias("best_n"))


def budgeted_targets(hits: DataFrame, group: list[str], first_round: bool = False, budget: int = COMPARISONS, chromosome: int = CHROMOSOME) -> DataFrame:
    """Hits of each locus's best targets by their highest score, as many as ``target_numbers`` allows; ties go to the smaller target."""
    best = hits.groupBy(*group, "locus", "target").agg(F.max("wscore").alias("best"))
    rank = F.row_number().over(Window.partitionBy(*group, "locus").orderBy(F.desc("best"), "target"))
    allowed = best.withColumn("r", rank).join(target_numbers(hits, group, first_round, budget, chromosome), group).where(F.col("best_n").isNull() | (F.col("r") <= F.col("best_n")))
    return hits.join(allowed.select(*group, "locus", "target"), [*group, "locus", "target"], "left_semi")


def drop_overlaps(hits: DataFrame, max_overlap: float = 5.0, width: int = BIN, allowed: list[tuple] = ()) -> DataFrame:
    """Hits that no better hit on the contig overlaps by more than ``max_overlap`` percent of the longer one.

    A rejected hit still rejects others, so this is one join and an anti-join: hits meet in the position bins
    that they share. Only hits of other loci, or of the same target, conflict, save for allowed pairs of loci.
    """
    if max_overlap >= 100:
        return hits
    own = hits.select("hit_id", "sample", "contig", "locus", "target", "wscore", "t_start", "t_end", "q_start", F.explode(F.sequence(F.floor(F.col("t_start") / width), F.floor((F.col("t_end") - 1) / width))).alias("bin"))
    better = own.select(*[F.col(c).alias(f"b_{c}") for c in own.columns])
    on = (F.col("sample") == F.col("b_sample")) & (F.col("contig") == F.col("b_contig")) & (F.col("bin") == F.col("b_bin"))
    order = lambda p: F.struct(-F.col(f"{p}wscore"), F.col(f"{p}target"), F.col(f"{p}t_start"), F.col(f"{p}q_start"), F.col(f"{p}hit_id"))
    shared = F.least("t_end", "b_t_end") - F.greatest("t_start", "b_t_start")
    longer = F.greatest(F.col("t_end") - F.col("t_start"), F.col("b_t_end") - F.col("b_t_start"))
    conflict = (order("b_") < order("")) & (shared * 100.0 > max_overlap * longer) & ((F.col("locus") != F.col("b_locus")) | (F.col("target") == F.col("b_target")))
    for a, b in allowed:
        conflict &= ~(F.col("locus").isin(a, b) & F.col("b_locus").isin(a, b))
    identity = ["hit_id", "sample", "contig", "target", "t_start", "t_end", "q_start", "wscore"]
    rejected = own.join(better, on & conflict, "left_semi").select(*identity).distinct()
    return hits.join(rejected, identity, "left_anti")


def ranked(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Paralog rank by score: hit number ``00``, ``01`` and so on."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("wscore"), "hit_id")) - 1
    return hits.withColumn("hit", F.lpad(n.cast("string"), 2, "0"))


def locus_coverage(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Coverage of each hit against the longest match of its locus in the sample."""
    longest = hits.groupBy(*keys).agg(F.max(F.col("q_end") - F.col("q_start")).alias("longest"))
    return hits.join(longest, keys).withColumn("locus_coverage", F.round(100.0 * (F.col("q_end") - F.col("q_start")) / F.col("longest"), 4))


def tolerated_paralogs(hits: DataFrame, keys: list[str], identity: float = PARALOG_IDENTITY, coverage: float = PARALOG_COVERAGE, depth: float = PARALOG_DEPTH, max_paralogs: int = -1) -> DataFrame:
    """Copies near enough to the best one in identity, coverage and depth (null passes), and the first few of them."""
    best = hits.groupBy(*keys).agg(F.min_by(F.struct("identity", "coverage", "depth"), F.struct(-F.col("wscore"), F.col("hit_id"))).alias("best"))
    near = lambda c, share: F.coalesce(F.col(c) >= share * F.col(f"best.{c}"), F.lit(True))
    out = hits.join(best, keys).where(near("identity", identity) & near("coverage", coverage) & near("depth", depth)).drop("best")
    if max_paralogs < 0:
        return out
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("wscore"), "hit_id"))
    return out.withColumn("__n", n).where(F.col("__n") <= max_paralogs + 1).drop("__n")


def depth_floor(hits: DataFrame, keys: list[str], tolerance: float = 0.5) -> DataFrame:
    """Hits at or over the floor 10^(log10(depth) * tolerance, 2 places) of the locus's best contig by score * log10(depth)."""
    safe = F.when(F.col("depth") > 0, F.col("depth"))
    best = hits.groupBy(*keys).agg(F.max_by("depth", F.struct(F.col("wscore") * F.log10(safe), F.col("depth"))).alias("d"))
    floor = F.when(F.col("d") > 1, F.pow(F.lit(10.0), F.round(F.log10("d") * tolerance, 2))).otherwise(0.0)
    return hits.join(best.withColumn("floor", floor), keys).where(F.col("depth") >= F.col("floor")).drop("d", "floor")


def best_target(hits: DataFrame, keys: list[str]) -> DataFrame:
    """The target of each locus with the best hit, ties by the mean score of its hits, then by name."""
    per = hits.groupBy(*keys, "target").agg(F.max("wscore").alias("best"), F.round(F.avg("wscore"), 9).alias("mean"))
    return per.groupBy(*keys).agg(F.min_by(F.struct("target", "best", "mean"), F.struct(-F.col("best"), -F.col("mean"), F.col("target"))).alias("x")).select(*keys, "x.target", "x.best", "x.mean")


def score_gate(hits: DataFrame, score: float = 0.13, identity: float = 65.0, coverage: float = 20.0) -> DataFrame:
    return hits.where((F.col("wscore") >= score) & (F.col("identity") >= identity) & (F.col("coverage") >= coverage))


def region_gate(hits: DataFrame, least: float = 10.0) -> DataFrame:
    """Hits that are covered well or not wedged."""
    return hits.where(~((F.col("coverage") < least) & (F.col("region") == "wedged")))


def recovery_summary(ext: DataFrame, keys: list[str]) -> DataFrame:
    """Loci, paralogs, lengths and coverage (of two decimal places) of best copies per sample.

    Means are taken from whole numbers and rounded half up at four places, so no order of summation shows in them.
    """
    best = F.col("hit") == "00"
    own = ext.groupBy(*keys).agg(F.count_distinct("locus").alias("loci"), F.count_if(~best).alias("paralogs"), F.count_if(best).alias("n"), F.sum(F.when(best, F.col("ref_len_matched"))).alias("total_best_length"), F.sum(F.when(best, F.round(F.col("coverage") * 100).cast("long"))).alias("hundredths"))
    mean = lambda total, units: F.expr(f"({2 * units} * {total} + n) div (2 * n)") / F.lit(10000.0)
    return own.select(*keys, "loci", "paralogs", mean("total_best_length", 10000).alias("mean_best_length"), "total_best_length", mean("hundredths", 100).alias("mean_best_coverage"))


def best_hit_report(ext: DataFrame) -> DataFrame:
    """The best copy of every (sample, marker, locus) with the number of its copies and frameshifts, and an ALL level."""
    w = Window.partitionBy("sample", "marker", "locus")
    out = ext.withColumns({"hits": F.count(F.lit(1)).over(w), "n": F.row_number().over(w.orderBy(F.desc("wscore"), "hit_id"))}).where("n = 1")
    return out.select("sample", "marker", "locus", "wscore", "coverage", "hits", F.when(F.col("frameshifts").isNull(), 0).otherwise(F.size(F.split("frameshifts", ","))).alias("n_frameshifts"))


def loci_by_level(report: DataFrame) -> DataFrame:
    """Loci per sample and marker, and over all markers as ALL."""
    levels = report.select("sample", F.explode(F.array("marker", F.lit("ALL"))).alias("marker"), "locus")
    return levels.groupBy("sample", "marker").agg(F.count_distinct("locus").alias("loci"))


def frameshift_positions(s: Column) -> Column:
    """Codon numbers at which a coding sequence holds N."""
    codon = F.transform(F.split(F.upper(s), ""), lambda c, i: F.when(c == "N", F.floor(i / 3) + 1))
    return F.array_join(F.array_distinct(F.transform(F.array_compact(codon), lambda p: p.cast("string"))), ",")


def gff_lines(hits: DataFrame, source: str = "phylospark") -> DataFrame:
    """GFF3 lines of hits: closed 1-based coordinates, first before last, attributes joined by semicolons."""
    lo, hi = F.least("t_start", "t_end") + 1, F.greatest("t_start", "t_end")
    attributes = F.concat_ws(";", F.concat(F.lit("ID="), F.col("hit_id").cast("string")), F.concat(F.lit("Name="), F.replace(F.url_encode(F.concat_ws(" ", F.col("locus").cast("string"), F.col("target").cast("string"))), F.lit("+"), F.lit("%20"))), F.concat(F.lit("WScore="), F.format_number("wscore", 5)))
    return hits.select("sample", F.concat_ws("\t", F.col("contig").cast("string"), F.lit(source), F.lit("match"), lo.cast("string"), hi.cast("string"), F.format_number("identity", 2), F.col("strand"), F.lit("."), attributes).alias("line"))


def gff_block_lines(hits: DataFrame, kind: str, source: str = "phylospark", parent: bool = False) -> DataFrame:
    """GFF3 lines of hits, one a block of ``blocks`` (0-based, half-open), numbered by ``part``.

    With ``parent`` a hit has an mRNA line over all its blocks before them, as part 0.
    """
    one = lambda s, e, feature: F.struct(s.alias("s"), e.alias("e"), F.lit(feature).alias("feature"))
    own = F.transform("blocks", lambda b: one(F.least(b.s, b.e) + 1, F.greatest(b.s, b.e), kind))
    if parent:
        own = F.concat(F.array(one(F.array_min(F.transform("blocks", lambda b: F.least(b.s, b.e))) + 1, F.array_max(F.transform("blocks", lambda b: F.greatest(b.s, b.e))), "mRNA")), own)
    flat = hits.select("*", F.posexplode(own).alias("part", "x")).withColumn("part", F.col("part") + (0 if parent else 1))
    quoted = lambda c: F.replace(F.url_encode(F.col(c).cast("string")), F.lit("+"), F.lit("%20"))
    attributes = F.concat_ws(";", F.concat(F.lit("ID="), F.col("hit_id").cast("string")), F.concat(F.lit("Name="), quoted("locus")), F.concat(F.lit("Identity="), F.format_string("%.2f", "identity")), F.concat(F.lit("Coverage="), F.format_string("%.2f", "coverage")), F.concat(F.lit("Depth="), F.format_string("%.4f", "depth")), F.concat(F.lit("Target="), quoted("target")))
    return flat.select("sample", "hit_id", "part", F.concat_ws("\t", quoted("contig"), F.lit(source), "x.feature", F.col("x.s").cast("string"), F.col("x.e").cast("string"), F.format_string("%.3f", "wscore"), "strand", F.lit("."), attributes).alias("line"))
