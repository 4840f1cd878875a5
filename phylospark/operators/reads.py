"""Reads: quality profiles, base content, trimming and sampling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators.near import Near, first_near, insert_lengths, tips_near

#: Trimming defaults.
MIN_LENGTH, TRIM_QUALITY, MEAN_QUALITY, MAX_N = 25, 13, 16, 5


def phred(quality, offset: int = 33):
    """Quality values of a quality string."""
    return F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset)


def read_stats(reads: DataFrame) -> DataFrame:
    """Least, largest and rounded-up median read length per sample."""
    n = F.length("sequence")
    return reads.groupBy("sample").agg(F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.ceil(F.percentile(n, F.lit(0.5))).alias("median_length"))


def base_quality_profile(reads: DataFrame) -> DataFrame:
    """Mean and quantiles of quality at each place, from counts per value so that no place gathers reads."""
    flat = reads.select("sample", "mate", F.posexplode(phred(F.col("quality"))).alias("pos", "q"))
    counted = flat.groupBy("sample", "mate", "pos", "q").agg(F.count(F.lit(1)).alias("n"))
    share = lambda p, name: F.expr(f"percentile(q, {p}, n)").alias(name)
    return counted.groupBy("sample", "mate", "pos").agg(F.round(F.sum(F.col("q") * F.col("n")) / F.sum("n"), 4).alias("mean_quality"), share(0.1, "p10"), share(0.25, "q1"), share(0.5, "median_quality"), share(0.75, "q3"), share(0.9, "p90"))


def per_read_quality(reads: DataFrame) -> DataFrame:
    """Reads per rounded-down mean quality."""
    q = phred(F.col("quality"))
    mean = F.floor(F.aggregate(q, F.lit(0), lambda a, x: a + x) / F.size(q)).cast("int")
    return reads.groupBy("sample", "mate", mean.alias("quality")).agg(F.count(F.lit(1)).alias("n_reads"))


def base_content(reads: DataFrame) -> DataFrame:
    """Share of each base at each place."""
    flat = reads.select("sample", "mate", F.posexplode(F.split("sequence", "")).alias("pos", "base"))
    return flat.groupBy("sample", "mate", "pos").agg(*[F.round(100.0 * F.count_if(F.col("base") == b) / F.count(F.lit(1)), 4).alias(f"pct_{b}") for b in "acgt"])


def gc_histogram(reads: DataFrame) -> DataFrame:
    """Reads per whole GC percentage, with the share of the sample's reads."""
    gc = F.floor(F.coalesce(seq.gc_percent_strict(F.col("sequence")), F.lit(0.0)) + 0.5).cast("int")
    return share_of_total(reads.groupBy("sample", "mate", gc.alias("gc")).agg(F.count(F.lit(1)).alias("n")), ["sample", "mate"], "n")


def share_of_total(counts: DataFrame, keys: list[str], value: str, name: str = "pct") -> DataFrame:
    """A count as a percentage of its group's total."""
    return counts.withColumn(name, F.round(100.0 * F.col(value) / F.sum(value).over(Window.partitionBy(*keys)), 6))


def length_grid(reads: DataFrame, key: str = "sample") -> DataFrame:
    """Reads per length for each sample and mate, zeros at lengths between the least and the largest of all."""
    counted = reads.groupBy(key, "mate", F.length("sequence").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    span = counted.agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    grid = counted.select(key, "mate").distinct().withColumn("length", F.explode(F.sequence(span.select("lo").scalar(), span.select("hi").scalar())))
    return grid.join(counted, [key, "mate", "length"], "left").fillna(0, ["n"])


def duplication_levels(reads: DataFrame) -> DataFrame:
    """Reads by how often their sequence occurs in the sample: 1 to 9, 10+, 50+, 100+ times."""
    copies = reads.groupBy("sample", "sequence").agg(F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("n") >= 100, ">100").when(F.col("n") >= 50, ">50").when(F.col("n") >= 10, ">10").otherwise(F.col("n").cast("string"))
    return copies.groupBy("sample", level.alias("level")).agg(F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_distinct"))


def qc_summary(reads: DataFrame) -> DataFrame:
    """Reads, bases, mean length and shares of bases of quality 20 and 30, and GC, per sample."""
    q = phred(F.col("quality"))
    own = reads.select("sample", F.length("sequence").alias("n"), F.size(F.filter(q, lambda x: x >= 20)).alias("q20"), F.size(F.filter(q, lambda x: x >= 30)).alias("q30"), seq.count_of(F.upper("sequence"), "GC").alias("gc"))
    pct = lambda c: F.round(100.0 * F.sum(c) / F.sum("n"), 4)
    return own.groupBy("sample").agg(F.count(F.lit(1)).alias("n_reads"), F.sum("n").alias("n_bases"), F.round(F.avg("n"), 4).alias("mean_length"), pct("q20").alias("pct_q20"), pct("q30").alias("pct_q30"), pct("gc").alias("pct_gc"))


def last_base_bias(reads: DataFrame, points: float = 10.0) -> DataFrame:
    """Samples whose longest reads end unevenly in A against T or C against G, which asks for a trim of one base."""
    longest = Window.partitionBy("sample")
    ends = reads.groupBy("sample", F.length("sequence").alias("n"), F.upper(F.right("sequence", F.lit(1))).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    ends = ends.withColumn("top", F.max("n").over(longest)).where("n = top")
    share = lambda b: 100.0 * F.sum(F.when(F.col("b") == b, F.col("c")).otherwise(0)) / F.sum("c")
    out = ends.groupBy("sample").agg((share("A") - share("T")).alias("at"), (share("C") - share("G")).alias("cg"))
    return out.select("sample", F.round("at", 4).alias("at_bias"), F.round("cg", 4).alias("cg_bias"), ((F.abs("at") > points) | (F.abs("cg") > points)).alias("trim"))


def fix_quality_offset(profile: DataFrame, quality: str = "q", keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Samples with a value over 42 were read with the wrong offset; 31 is taken off."""
    top = F.max(quality).over(Window.partitionBy(*keys))
    return profile.withColumn(quality, F.when(top > 42, F.col(quality) - 31).otherwise(F.col(quality)))


def trim_quality(reads: DataFrame, trim: int = TRIM_QUALITY, mean: int = MEAN_QUALITY, min_length: int = MIN_LENGTH, max_n: int = MAX_N, left: int = 0, right: int = 0) -> DataFrame:
    """Both ends cut back to the first and last base of quality ``trim``, then reads of low mean quality, many N or short ones dropped."""
    reads = reads.withColumns({"sequence": F.substring(F.col("sequence"), F.lit(left + 1), F.length("sequence") - left - right), "quality": F.substring(F.col("quality"), F.lit(left + 1), F.length("quality") - left - right)})
    low = "[" + "".join(f"\\x{c:02x}" for c in range(33, 33 + trim)) + "]"
    lead = F.length(F.regexp_extract("quality", f"^({low}*)", 1))
    tail = F.length(F.regexp_extract(F.reverse(F.col("quality")), f"^({low}*)", 1))
    # one struct a read, so that no later step computes the ends or the mean anew
    q = phred(F.col("quality"))
    cut = F.struct(lead.alias("lead"), F.greatest(F.lit(0), F.length("quality") - lead - tail).alias("kept"), q.alias("q"))
    one = reads.withColumn("__cut", F.element_at(F.transform(F.array(cut), lambda c: F.struct(c.lead.alias("lead"), c.kept.alias("kept"), F.aggregate(F.slice(c.q, c.lead + 1, c.kept), F.lit(0), lambda a, x: a + x).alias("sum"))), 1))
    good = one.where((F.col("__cut.kept") >= min_length) & (F.col("__cut.sum") >= mean * F.col("__cut.kept")))
    good = good.withColumns({c: F.substring(F.col(c), F.col("__cut.lead") + 1, F.col("__cut.kept")) for c in ("sequence", "quality")}).drop("__cut")
    return good.where(seq.count_of(F.upper("sequence"), "N") <= max_n)


#: Windows of adaptors or contaminants that a task holds at a time, 16 bytes each and as much for each piece; more go in further slices.
HELD_KMERS = 1 << 20


def _listed(frame: DataFrame, windows: Column) -> list[tuple[list[str], list[str]]]:
    """Slices of (windows, names) of a list of short sequences, each of bounded size."""
    rows = frame.select("name", F.explode(windows).alias("w")).groupBy("w").agg(F.min("name").alias("name")).orderBy("w")
    slices: list[tuple[list[str], list[str]]] = [([], [])]
    for row in rows.toLocalIterator():
        if len(slices[-1][0]) == HELD_KMERS:
            slices.append(([], []))
        slices[-1][0].append(row["w"])
        slices[-1][1].append(row["name"])
    return slices


def _windows(k: int) -> Column:
    n = F.length("sequence")
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.substring(F.lower("sequence"), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def _first(windows: list[str], names: list[str], k: int, distance: int) -> Column:
    """The first window of ``sequence`` near one of ``windows``: (place from 0, least name), null where there is none."""
    order = sorted(set(names))
    rank = {n: i for i, n in enumerate(order)}
    near = Near(windows, [rank[n] for n in names], k, distance)

    @F.arrow_udf(returnType="pos int, name string")
    def search(sequences: pa.Array) -> pa.Array:
        place, name = first_near(sequences, near)
        return _found(place, name, order, place < 0)

    return _once(search)(F.col("sequence"))


def _once(search):
    """A search whose calls stay where they are written, once a row.

    A filter on what they find would else be moved below the step that cuts the reads, so that each read passes the
    search with the whole sequence that it was cut from, and is searched again above.
    """
    return search.asNondeterministic()


def _found(value: np.ndarray, name: np.ndarray, order: list[str], none: np.ndarray) -> pa.Array:
    names = pa.array(order, pa.string()).take(pa.array(name, pa.int64(), mask=none))
    return pa.StructArray.from_arrays([pa.array(value, pa.int32(), mask=none), names], ["pos", "name"], mask=pa.array(none))


def trim_adaptors(reads: DataFrame, adaptors: DataFrame, k: int = 21, distance: int = 2) -> DataFrame:
    """Reads cut at the first place where a k-mer within ``distance`` places of an adaptor's begins, with that ``adaptor``.

    A near k-mer agrees with the adaptor's in one of ``distance`` + 1 pieces, so candidates are looked up by pieces where the
    read is and their differences counted; no k-mer and no read is shuffled. Only sequences go through Arrow. Adaptors are a
    short list, which the driver reads; past ``HELD_KMERS`` k-mers it is searched in slices. Letters other than A, C, G and T
    differ from all. Null sequences have no adaptor.
    """
    found = F.array_compact(F.array(*[_first(*own, k, distance) for own in _listed(adaptors, _windows(k))]))
    out = reads.withColumn("__hit", F.array_min(found))
    keep = F.coalesce(F.col("__hit.pos"), F.length("sequence"))
    return out.withColumns({"adaptor": F.col("__hit.name"), "sequence": F.substring(F.col("sequence"), F.lit(1), keep), "quality": F.substring(F.col("quality"), F.lit(1), keep)}).drop("__hit")


def trim_adaptor_tips(reads: DataFrame, adaptors: DataFrame, least: int = 11, k: int = 21, distance: int = 2) -> DataFrame:
    """Reads cut where their end is the start of an adaptor, ``least`` to ``k`` - 1 bases of it, within ``distance``.

    The longest such end goes. Starts of adaptors are looked up by pieces, as in ``trim_adaptors``.
    """
    tips, names = [], set()
    for n in range(least, k):
        starts = _listed(adaptors.where(F.length("sequence") >= n), F.array(F.substring(F.lower("sequence"), 1, n)))
        tips += [(own, name, n) for own, name in starts]
        names |= {x for _, name in starts for x in name}
    order = sorted(names)
    rank = {n: i for i, n in enumerate(order)}
    near = [Near(own, [rank[x] for x in name], n, distance) for own, name, n in tips if own]

    @F.arrow_udf(returnType="pos int, name string")
    def search(sequences: pa.Array) -> pa.Array:
        size, name = tips_near(sequences, near)
        return _found(size, name, order, size == 0)

    out = reads.withColumn("__hit", _once(search)(F.col("sequence")))
    keep = F.length("sequence") - F.coalesce(F.col("__hit.pos"), F.lit(0))
    named = F.coalesce(F.col("adaptor"), F.col("__hit.name")) if "adaptor" in reads.columns else F.col("__hit.name")
    return out.withColumns({"adaptor": named, "sequence": F.substring(F.col("sequence"), F.lit(1), keep), "quality": F.substring(F.col("quality"), F.lit(1), keep)}).drop("__hit")


#: K, least k at the tip, and distance of the two rounds of adaptor trimming.
ADAPTOR_ROUNDS = ((21, 11, 2), (19, 9, 1))


def trim_adaptors_in_rounds(reads: DataFrame, adaptors: DataFrame, rounds=ADAPTOR_ROUNDS, min_length: int = MIN_LENGTH) -> DataFrame:
    """Rounds of ``trim_adaptors`` and ``trim_adaptor_tips``; reads that get short are dropped, columns name each round's adaptor."""
    names = reads.columns
    for n, (k, least, distance) in enumerate(rounds, 1):
        cut = trim_adaptor_tips(trim_adaptors(reads, adaptors, k, distance), adaptors, least, k, distance)
        names = [*names, f"adaptor_{n}"]
        reads = cut.withColumnRenamed("adaptor", f"adaptor_{n}").where(F.length("sequence") >= min_length).select(*names)
    return reads


def trim_poly_a(reads: DataFrame, least: int = 4) -> DataFrame:
    """Runs of A or of T at either end, ``least`` long or longer, cut from RNA reads."""
    run = f"(?:[aA]{{{least},}}|[tT]{{{least},}})"
    lead = F.length(F.regexp_extract("sequence", f"^({run})", 1))
    rest = F.substring(F.col("sequence"), F.col("lead") + 1, F.length("sequence"))
    own = reads.withColumn("lead", lead).withColumn("kept", F.length(F.regexp_replace(rest, f"{run}$", "")))
    return own.withColumns({c: F.substring(F.col(c), F.col("lead") + 1, F.col("kept")) for c in ("sequence", "quality")}).drop("lead", "kept")


def trim_pairs_evenly(reads: DataFrame, fragment: str = "fragment") -> DataFrame:
    """Both mates of a fragment cut to the shorter one's length."""
    shortest = reads.groupBy("sample", fragment).agg(F.min(F.length("sequence")).alias("__n"))
    return reads.join(shortest, ["sample", fragment]).withColumns({c: F.substring(F.col(c), F.lit(1), F.col("__n")) for c in ("sequence", "quality")}).drop("__n")


#: Reads whose mates are held against them at a time.
PAIRS = 4096


def trim_mate_overlap(reads: DataFrame, fragment: str = "fragment", mate: str = "mate", penalty: int = 3, least: int = 14) -> DataFrame:
    """Reads that run past the fragment they come from, cut at its end, which the mate shows; ``insert`` is the fragment's length.

    A read's facing bases are held against its mate's complements at every offset (``near.insert_lengths``); the insert is null where no offset
    has enough votes, and where there is no mate. Mates meet by sample and fragment, the one shuffle; of several rows of one
    mate the least sequence stands for it. Rows stay as many as they are.
    """
    other = reads.where(F.col("sequence").isNotNull()).groupBy("sample", fragment, mate).agg(F.min("sequence").alias("__other"))
    other = other.withColumn(mate, 3 - F.col(mate))

    @F.arrow_udf(returnType="int")
    def inserts(one: pa.Array, two: pa.Array) -> pa.Array:
        found = [insert_lengths(one.slice(i, PAIRS), two.slice(i, PAIRS), penalty, least) for i in range(0, len(one), PAIRS)]
        n = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pa.array(n, pa.int32(), mask=n < 0)

    out = reads.join(other, ["sample", fragment, mate], "left").withColumn("insert", _once(inserts)(F.col("sequence"), F.col("__other")))
    keep = F.coalesce(F.col("insert"), F.length("sequence"))
    return out.withColumns({c: F.substring(F.col(c), F.lit(1), keep) for c in ("sequence", "quality")}).select(*reads.columns, "insert")


def drop_contaminated(reads: DataFrame, contaminants: DataFrame, k: int = 31, distance: int = 1) -> DataFrame:
    """Reads without a k-mer within ``distance`` of a contaminant's, on either strand; found inside the row by pieces."""
    both = contaminants.select("sequence").union(contaminants.select(seq.reverse_complement(F.col("sequence")))).withColumn("name", F.lit(""))
    found = F.array_compact(F.array(*[_first(*own, k, distance) for own in _listed(both, _windows(k))]))
    return reads.where(F.size(found) == 0)


def qc_report(before: DataFrame, after: DataFrame, adaptor_content: DataFrame | None = None) -> DataFrame:
    """Per sample: reads and bases in and out with their shares, mean length against before, shares of reads of quality 20 and 30, GC.

    ``adaptor_content`` (sample, mate, position, pct) adds the mean over mates of the highest adaptor share at a place.
    """
    def totals(reads: DataFrame, end: str) -> DataFrame:
        q = phred(F.col("quality"))
        mean = F.floor(F.aggregate(q, F.lit(0), lambda a, x: a + x) / F.size(q))
        own = reads.select("sample", F.length("sequence").alias("n"), mean.alias("q"), F.floor(F.coalesce(seq.gc_percent_strict(F.col("sequence")), F.lit(0.0)) + 0.5).alias("gc"))
        share = lambda c, name: F.round(100.0 * F.count_if(c) / F.count(F.lit(1)), 4).alias(name)
        out = [F.count(F.lit(1)).alias(f"reads_{end}"), F.sum("n").alias(f"bases_{end}")]
        if end == "out":
            out += [share(F.col("q") >= 20, "pct_reads_q20"), share(F.col("q") >= 30, "pct_reads_q30"), F.round(F.avg("gc"), 4).alias("mean_gc")]
        return own.groupBy("sample").agg(*out)

    both = totals(before, "in").join(totals(after, "out"), "sample", "left").na.fill(0, ["reads_out", "bases_out"])
    pct = lambda a, b: F.round(F.try_divide(100.0 * a, b), 4)
    c = F.col
    out = both.withColumns({"pct_reads": pct(c("reads_out"), c("reads_in")), "pct_bases": pct(c("bases_out"), c("bases_in")), "pct_mean_length": pct(F.try_divide(c("bases_out"), c("reads_out")), F.try_divide(c("bases_in"), c("reads_in")))})
    if adaptor_content is None:
        return out
    top = adaptor_content.groupBy("sample", "mate").agg(F.max("pct").alias("top")).groupBy("sample").agg(F.round(F.avg("top"), 4).alias("pct_adaptor"))
    return out.join(top, "sample", "left")


def adaptor_content(reads: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Share of a sample's reads in which an adaptor has begun at each place, from the cut of ``trimmed``; a row a place where one begins."""
    all_ = reads.groupBy("sample", "mate").agg(F.count(F.lit(1)).alias("all"))
    begun = trimmed.where(F.col("adaptor").isNotNull()).groupBy("sample", "mate", F.length("sequence").alias("position")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("sample", "mate").orderBy("position")
    return begun.withColumn("n", F.sum("n").over(w)).join(all_, ["sample", "mate"]).select("sample", "mate", "position", F.round(100.0 * F.col("n") / F.col("all"), 4).alias("pct"))


def adaptor_counts(trimmed: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Reads per adaptor, a column a sample, most frequent first."""
    wide = trimmed.where(F.col("adaptor").isNotNull()).groupBy("adaptor").pivot("sample", samples).count().na.fill(0)
    total = sum((F.col(f"`{c}`") for c in wide.columns[1:]), F.lit(0))
    return wide.withColumn("total", total).orderBy(F.desc("total"), "adaptor")


def sample_reads(reads: DataFrame, bases: int, seed: int = 0) -> DataFrame:
    """Fragments in a seeded order until a sample has ``bases`` bases; mates stay together.

    Bases are summed per hash slot first, so a sample's order is taken slot by slot, not in one sort.
    """
    key = F.md5(F.concat("read_id", F.lit(str(seed))).cast("binary"))
    slot = F.substring(key, 1, 2)  # 256 of them
    fragments = reads.groupBy("sample", "read_id").agg(F.sum(F.length("sequence")).alias("n")).withColumns({"key": key, "slot": slot})
    slots_ = fragments.groupBy("sample", "slot").agg(F.sum("n").alias("m"))
    before = slots_.withColumn("before", F.sum("m").over(Window.partitionBy("sample").orderBy("slot")) - F.col("m"))
    run = F.sum("n").over(Window.partitionBy("sample", "slot").orderBy("key", "read_id").rowsBetween(Window.unboundedPreceding, 0))
    kept = fragments.withColumn("run", run).join(before, ["sample", "slot"]).where(F.col("before") + F.col("run") <= bases)
    return reads.join(kept.select("sample", "read_id"), ["sample", "read_id"], "left_semi")
