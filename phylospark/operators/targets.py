"""Clusters, loci, targets and baits: occupancy, selection, naming and tiling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq


def split_names(frame: DataFrame, name: str = "name", sep: str = "__") -> DataFrame:
    """Sample, locus part and paralog rank (0 if absent) from names joined by ``__``; ``ref`` marks references."""
    parts = F.split(F.col(name), sep)
    last = F.element_at(parts, -1)
    rank = F.when(last.rlike("^[0-9]+$") & (F.size(parts) > 1), last.cast("int")).otherwise(0)
    return frame.withColumns({"sample": parts[0], "rank": rank, "is_ref": last == "ref"})


def keep_ranks(frame: DataFrame, max_rank: int = -1) -> DataFrame:
    return frame if max_rank < 0 else frame.where(F.col("rank") <= max_rank)


def sanitise(name: Column, mark: str = "_") -> Column:
    return F.translate(name, ":()", mark * 3)


def tag(description: Column, key: str) -> Column:
    """The value of ``[key=value]`` in a description."""
    return F.regexp_extract(description, rf"\[{key}=([^\]]+)\]", 1)


def cluster_occupancy(clusters: DataFrame, min_species: int = 2) -> DataFrame:
    """Samples, species and members of clusters with enough species and more than one member."""
    out = clusters.groupBy("centroid").agg(F.count_distinct("sample").alias("samples"), F.count_distinct("species").alias("species"), F.count(F.lit(1)).alias("members"))
    return out.where((F.col("species") >= min_species) & (F.col("members") > 1))


def cluster_copies(clusters: DataFrame) -> DataFrame:
    """Samples, sequences, median copies per sample, longest member and the centroid's share of it."""
    per = clusters.groupBy("centroid", "sample").agg(F.count(F.lit(1)).alias("c"), F.max("length").alias("top"), F.max(F.when(F.col("member") == F.col("centroid"), F.col("length"))).alias("own"))
    return per.groupBy("centroid").agg(F.count(F.lit(1)).alias("samples"), F.sum("c").alias("sequences"), F.expr("percentile(c, 0.5)").alias("median_copies"), F.max("top").alias("longest"), F.max("own").alias("centroid_length"))


def select_clusters(clusters: DataFrame, min_samples: int = 4, max_copies: float = 1.5, min_length: int = 500) -> DataFrame:
    c = cluster_copies(clusters)
    return c.where((F.col("samples") >= min_samples) & (F.col("median_copies") <= max_copies) & (F.col("centroid_length") >= min_length))


def inclusions(clusters: DataFrame) -> DataFrame:
    """Other loci in each centroid's cluster, and the loci whose clusters hold it."""
    lead = clusters.where(F.col("member") == F.col("centroid")).select("centroid", F.col("locus").alias("own"))
    met = clusters.join(lead, "centroid").where(F.col("locus") != F.col("own"))
    holds = met.groupBy(F.col("own").alias("locus")).agg(F.array_join(F.array_sort(F.collect_set("locus")), ",").alias("includes"))
    held = met.groupBy("locus").agg(F.array_join(F.array_sort(F.collect_set("own")), ",").alias("included_in"))
    return holds.join(held, "locus", "full")


def representatives(clusters: DataFrame, keys: list[str], length_share: float = 0.75, depth_share: float = 0.3333, score: str | None = None, retain: DataFrame | None = None) -> DataFrame:
    """Centroids of a locus in order of samples, length and ``score``; others than the first need shares of its length and sequences.

    A centroid whose cluster holds a sample of ``retain`` needs only the length. Ties go to the smaller centroid.
    """
    lead = clusters.where(F.col("member") == F.col("centroid")).select("centroid", *keys, (F.col(score) if score else F.lit(0.0)).alias("__score"))
    c = cluster_copies(clusters).join(lead, "centroid")
    if retain is not None:
        c = c.join(clusters.join(retain.select("sample").distinct(), "sample", "left_semi").select("centroid").distinct().withColumn("__held", F.lit(True)), "centroid", "left")
    held = F.coalesce(F.col("__held"), F.lit(False)) if retain is not None else F.lit(False)
    w = Window.partitionBy(*keys).orderBy(F.desc("samples"), F.desc("centroid_length"), F.desc("__score"), "centroid")
    first = lambda x: F.first(x).over(w)
    ranked = c.withColumns({"rank": F.row_number().over(w), "top_length": first("centroid_length"), "top_sequences": first("sequences")})
    good = (F.col("rank") == 1) | ((F.col("centroid_length") >= length_share * F.col("top_length")) & ((F.col("sequences") >= depth_share * F.col("top_sequences")) | held))
    return ranked.where(good).select(*keys, "centroid", "rank", "samples", "centroid_length")


def split_paralogs(reps: DataFrame, keys: list[str], min_share: float = 0.6666) -> DataFrame:
    """Names of a locus's representatives: numbered ``.PAR`` if well sampled, else ``.PMIN``; single ones keep the locus."""
    w = Window.partitionBy(*keys)
    share = F.col("samples") / F.max("samples").over(w)
    number = F.sum(F.when(share >= min_share, 1).otherwise(0)).over(w.orderBy("rank"))
    locus = F.concat_ws("_", *keys)
    name = F.when(F.count(F.lit(1)).over(w) == 1, locus).when(share >= min_share, F.concat(locus, F.lit(".PAR"), number.cast("string"))).otherwise(F.concat(locus, F.lit(".PMIN")))
    return reps.withColumn("name", name)


def long_and_short(seqs: DataFrame, keys: list[str], share: float = 0.5) -> DataFrame:
    longest = seqs.groupBy(*keys).agg(F.max("length").alias("longest"))
    return seqs.join(longest, keys).withColumn("part", F.when(F.col("length") > share * F.col("longest"), "long").otherwise("short")).drop("longest")


def eligible_clusters(seqs: DataFrame, keys: list[str], min_samples: int = 4, max_copies: float = -1) -> DataFrame:
    """Clusters worth an alignment: enough samples, and few enough copies in their median (-1: any)."""
    per = seqs.groupBy(*keys, "sample").agg(F.count(F.lit(1)).alias("c"))
    out = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"), F.expr("percentile(c, 0.5)").alias("median_copies"))
    return out.where((F.col("samples") >= min_samples) & (F.lit(max_copies == -1) | (F.col("median_copies") <= max_copies)))


def most_common_target(ext: DataFrame, min_samples: int = 4) -> DataFrame:
    """The target that best copies of a locus name most often; ties by name."""
    best = ext.where("hit = '00'").groupBy("locus", "target").agg(F.count(F.lit(1)).alias("n"))
    out = best.groupBy("locus").agg(F.min_by("target", F.struct(-F.col("n"), F.col("target"))).alias("target"), F.max("n").alias("votes"), F.sum("n").alias("samples"))
    return out.where(F.col("samples") >= min_samples)


def summary(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Median, mean, deviation and range of columns, a row each."""
    long = frame.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.measure", "x.v")
    return long.groupBy("measure").agg(F.expr("percentile(v, 0.5)").alias("median"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_samp("v"), 6).alias("sd"), F.min("v").alias("least"), F.max("v").alias("largest"))


def equal_width_histogram(frame: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    return frame.where(F.col(column).isNotNull()).groupBy(F.expr(f"width_bucket(cast(`{column}` as double), {low}D, {high}D, {bins})").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def upper_whisker(frame: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Third quartile plus three interquartile ranges."""
    q = F.expr(f"percentile(`{column}`, array(0.25, 0.75))")
    return frame.groupBy(*keys).agg(q.alias("q")).select(*keys, F.round(F.col("q")[1] + 3 * (F.col("q")[1] - F.col("q")[0]), 6).alias("cap"))


def min_max(frame: DataFrame, column: str) -> DataFrame:
    """A column scaled to 0..1; 0.5 if it is flat."""
    edge = frame.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
    return frame.withColumn("scaled", F.when(hi == lo, 0.5).otherwise((F.col(column) - lo) / (hi - lo)))


def select_loci(stats: DataFrame, ranges: dict[str, tuple[float | None, float | None]], null_passes: tuple[str, ...] = ()) -> DataFrame:
    """Loci inside all ranges, in one pass; columns of ``null_passes`` let null through."""
    return stats.where(_passing(ranges, null_passes)[-1])


def _passing(ranges: dict, null_passes: tuple[str, ...]) -> list[Column]:
    out, all_ = [], F.lit(True)
    for c, (low, high) in ranges.items():
        inside = (F.col(c) >= (low if low is not None else float("-inf"))) & (F.col(c) <= (high if high is not None else float("inf")))
        all_ = all_ & F.coalesce(inside, F.lit(c in null_passes))
        out.append(all_)
    return out


def selection_funnel(stats: DataFrame, ranges: dict, null_passes: tuple[str, ...] = (), footprint: tuple[str, str] = ("len_long_exons_retained", "length")) -> DataFrame:
    """Loci left after each range in order, and the bases that the last ones cover."""
    steps = _passing(ranges, null_passes)
    counts = [F.count_if(c).alias(f"after_{n}") for n, c in zip(ranges, steps, strict=True)]
    return stats.agg(*counts, F.sum(F.when(steps[-1], F.coalesce(*footprint))).alias("footprint"))


def funnel(raw: DataFrame, filtered: DataFrame, final: DataFrame) -> DataFrame:
    """Samples of each locus before and after filters and whether it was split; names lose ``.PAR``/``.PMIN``."""
    base = final.select(F.regexp_replace("name", r"\.(PAR\d+|PMIN)$", "").alias("locus"), F.col("samples").alias("final_samples"), F.col("name").rlike(r"\.(PAR\d+|PMIN)$").alias("split"))
    one = base.groupBy("locus").agg(F.max("final_samples").alias("final_samples"), F.max("split").alias("split"), F.count(F.lit(1)).alias("targets"))
    return raw.join(filtered, "locus", "left").join(one, "locus", "left").withColumn("pct_retained", F.round(100.0 * F.coalesce(F.col("filtered_samples"), F.lit(0)) / F.col("raw_samples"), 4))


def reference_info(targets: DataFrame, sep: str = "-") -> DataFrame:
    """Whether all names carry the separator, the number of loci, and the summed mean length of loci."""
    named = targets.select("target", F.element_at(F.split("target", sep), -1).alias("locus"), F.length("sequence").alias("n"), (F.instr("target", sep) > 0).alias("has"))
    per = named.groupBy("locus").agg(F.avg("n").alias("mean"), F.min("has").alias("has"))
    return per.agg(F.min("has").alias("all_named"), F.count(F.lit(1)).alias("loci"), F.round(F.sum("mean"), 4).alias("total_length"))


def shred(seqs: DataFrame, max_length: int, is_cds: bool = False, name: str = "name", sequence: str = "sequence") -> DataFrame:
    """Sequences longer than ``max_length`` in near-equal pieces named ``_start_end``; coding ones cut between codons."""
    n = F.length(sequence)
    pieces = F.ceil(n / max_length)
    unit = 3 if is_cds else 1
    size = F.ceil(n / pieces / unit) * unit if is_cds else F.floor(n / pieces)
    rest = F.lit(0) if is_cds else n - size * pieces
    start = lambda i: i * size + F.least(i, rest)
    cut = F.transform(F.sequence(F.lit(0), (pieces - 1).cast("int")), lambda i: F.struct((start(i) + 1).cast("int").alias("a"), F.least(start(i + 1), n).cast("int").alias("b")))
    out = seqs.where(n > 0).withColumn("piece", F.explode(cut)).where("piece.a <= piece.b")
    text = F.substring(F.col(sequence), F.col("piece.a"), F.col("piece.b") - F.col("piece.a") + 1)
    named = F.when(n > max_length, F.concat_ws("_", name, F.col("piece.a").cast("string"), F.col("piece.b").cast("string"))).otherwise(F.col(name))
    return out.select(named.alias("name"), text.alias("sequence"))


def tile(seqs: DataFrame, length: int = 120, step: int = 1, name: str = "name", sequence: str = "sequence") -> DataFrame:
    """Every window of ``length`` bases of ungapped upper-case sequences, numbered from 1."""
    from phylospark.operators.similarity import kmers

    bare = seqs.select(F.col(name).alias("name"), F.upper(F.regexp_replace(sequence, "-", "")).alias("sequence"))
    return kmers(bare, ["name"], length, step).select("name", (F.floor((F.col("pos") - 1) / step) + 1).cast("int").alias("bait_no"), F.col("kmer").alias("bait"))


def dereplicate(baits: DataFrame) -> DataFrame:
    """One bait of those that are equal on either strand: the first by name and number."""
    strand = F.least("bait", seq.reverse_complement(F.col("bait")))
    return baits.groupBy(strand.alias("canonical")).agg(F.min_by(F.struct("name", "bait_no", "bait"), F.struct("name", "bait_no")).alias("b"), F.count(F.lit(1)).alias("copies")).select("b.name", "b.bait_no", "b.bait", "copies")


def distinct_in_locus(baits: DataFrame, keys: list[str]) -> DataFrame:
    """Equal baits of a locus once, under the last name, and the last number of that name."""
    last = F.max(F.struct("name", "bait_no"))
    return baits.groupBy(*keys, "bait").agg(last.alias("x")).select(*keys, "bait", "x.name", "x.bait_no")


def bait_stats(baits: DataFrame, chemistry: str = "RNA-DNA", sodium: float = 0.9, formamide: float = 0.0) -> DataFrame:
    """GC, melting temperature, masked share, longest homopolymer and N of every bait."""
    b = F.col("bait")
    out = baits.withColumn("gc", F.round(F.coalesce(seq.gc_percent(b), F.lit(0.0)), 2))
    return out.withColumns({"melt_temp": seq.melting_temperature(F.col("gc"), F.length(b), chemistry, sodium, formamide), "low_complexity": F.round(seq.low_complexity_percent(b), 2), "max_homopolymer_len": seq.longest_homopolymer(b), "ns": seq.count_of(F.upper(b), "N")})


def filter_baits(baits: DataFrame, gc: tuple[float, float] = (30, 50), melt: tuple[float, float] = (0, 120), masked: float = 25, homopolymer: int = 6, max_n: int = 0) -> DataFrame:
    """Every bait with its figures and whether it is accepted."""
    s = bait_stats(baits)
    good = F.col("gc").between(*gc) & F.col("melt_temp").between(*melt) & (F.col("low_complexity") <= masked) & (F.col("max_homopolymer_len") <= homopolymer) & (F.col("ns") <= max_n)
    return s.withColumn("accepted", good)


#: Bits of the filter of a reference's k-mers, at most (64 MB), and of one part of it.
FILTER, PART = 29, 16
_TURNED = str.maketrans(seq.BASES, seq.COMPLEMENTS)


def _mixed(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(by)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of each key in a filter of 2 ** ``size`` bits."""
    one, other = _mixed(keys, 0xBF58476D1CE4E5B9), _mixed(keys, 0xD6E8FEB86659FD93)
    return (one >> np.uint64(64 - size)).astype(np.int64), (other >> np.uint64(64 - size)).astype(np.int64)


def canonical_keys(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all k-mers of upper-case texts, on the strand that makes them least: the text's number and two 64-bit keys.

    k-mers of A, C, G and T up to 31 letters are their own first key, the second one is 0; others have 127 bits of a cryptographic hash.
    """
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    n = np.maximum(sizes - k + 1, 0)
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begins[row]
    first, second = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    codes = np.full(128, 4, np.uint64)
    codes[[ord(c) for c in "ACGT"]] = np.arange(4)
    c = np.where(raw < 128, codes[np.minimum(raw, 127)], np.uint64(4))
    odd = np.append(0, np.cumsum(c > 3))
    other = np.ones(len(at), bool) if k > 31 else odd[at + k] > odd[at]
    if k <= 31:
        ahead, back = c & np.uint64(3), ~c & np.uint64(3)
        whole, turned, done, m = np.zeros_like(c), np.zeros_like(c), 0, 1
        shift = lambda x, by: np.append(x[by:], np.zeros(min(by, len(x)), np.uint64))
        while m <= k:  # windows of 1, 2, 4 ... letters, of which those in k's binary form make up the k-mer
            if k & m:
                whole = (whole << np.uint64(2 * m)) | shift(ahead, done)
                turned = turned | (shift(back, done) << np.uint64(2 * done))
                done += m
            ahead, back, m = (ahead << np.uint64(2 * m)) | shift(ahead, m), back | (shift(back, m) << np.uint64(2 * m)), 2 * m
        first[:] = np.minimum(whole, turned)[at]
    begin = at - begins[row]
    for i in np.flatnonzero(other):
        x = texts[row[i]][begin[i] : begin[i] + k]
        digest = hashlib.blake2b(min(x, x[::-1].translate(_TURNED)).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        first[i], second[i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little") | 1
    return row, first, second


def _keys_of(frame: DataFrame, keep: list[str], text: str, k: int, held=None, size: int = 0, best: bool = False) -> DataFrame:
    """(keep, a, b): keys of the k-mers of each row's text; with a filter only those in it, with ``best`` one in the longest run of them."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*keep).schema)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if held is None else held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                row, a, b = canonical_keys(batch.column("__text").to_pylist(), k)
                if bits is not None:
                    one, other = _places(a ^ b, size)
                    found = ((bits[one >> 3] >> (one & 7)) & (bits[other >> 3] >> (other & 7)) & 1).astype(bool)
                    if best and found.any():
                        at = np.arange(len(row))
                        begin = ~found | np.append(True, (row[1:] != row[:-1]) | ~found[:-1])
                        run = at - np.maximum.accumulate(np.where(begin, at, 0)) + found
                        order = np.lexsort((run, row))
                        last = order[np.append(row[1:] != row[:-1], True)]  # rows come in order, so order's blocks are theirs
                        chosen = last[found[last]]
                    else:
                        chosen = np.flatnonzero(found)
                    row, a, b = row[chosen], a[chosen], b[chosen]
                kept = [batch.column(c).take(pa.array(row)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], [*keep, "a", "b"])

    return frame.where(F.length(text) >= k).select(*keep, F.upper(text).alias("__text")).mapInArrow(make, f"{fields}{', ' if keep else ''}a long, b long")


def _filter(keys: DataFrame, size: int) -> np.ndarray:
    """A filter of 2 ** ``size`` bits, made in parts by the tasks; the driver holds it, FILTER bounds it."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("a").to_numpy().view(np.uint64) ^ batch.column("b").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(_places(own, size))))], ["at"])

    def part(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << PART, bool)
        bits[frame["at"].to_numpy() & ((1 << PART) - 1)] = True
        return pd.DataFrame({"part": [int(frame["at"].iloc[0]) >> PART], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros(1 << size - 3, np.uint8)
    parts = keys.mapInArrow(places, "at long").distinct().groupBy(F.shiftright("at", PART)).applyInPandas(part, "part long, bits binary")
    for found in parts.toLocalIterator():
        out[found["part"] << PART - 3 :][: 1 << PART - 3] = np.frombuffer(found["bits"], np.uint8)
    return out


def exclude_matches(baits: DataFrame, reference: DataFrame, k: int = 31) -> DataFrame:
    """Baits that share no k-mer, on either strand, with a reference sequence.

    A filter of the reference's k-mers goes to the tasks, 64 MB at most; what it lets through by mistake costs work, never results. First
    each bait sends one k-mer, from its longest run of those in the filter; baits that are left send all of theirs in it. So few k-mers are shuffled.
    """
    from phylospark.operators.similarity import STRETCH

    s = F.col("sequence")
    pieces = F.transform(F.sequence(F.lit(1), F.length(s) - (k - 1), F.lit(2 * STRETCH)), lambda i: F.substring(s, i, F.lit(2 * STRETCH + k - 1)))
    cut = reference.where(F.length(s) >= k).select(F.explode(pieces).alias("sequence"))
    ref = _keys_of(cut, [], "sequence", k)
    letters = reference.agg(F.sum(F.length(s))).first()[0] or 0
    size = min(FILTER, max(PART, int(16 * letters).bit_length()))
    held = baits.sparkSession.sparkContext.broadcast(_filter(ref, size))
    id_ = ["name", "bait_no"]
    matched = lambda own: own.join(ref.distinct(), ["a", "b"], "left_semi").select(*id_).distinct()
    left = baits.join(matched(_keys_of(baits, id_, "bait", k, held, size, best=True)), id_, "left_anti")
    return left.join(matched(_keys_of(left, id_, "bait", k, held, size)), id_, "left_anti")


def bait_table(baits: DataFrame, targets: DataFrame, bait_length: int = 120, min_tiling: float = 1.0) -> DataFrame:
    """Baits, targets, longest target, tiling and reasons for removal of every locus, with those that lack baits."""
    b = baits.groupBy("locus").agg(F.count(F.lit(1)).alias("baits"))
    t = targets.groupBy("locus").agg(F.count(F.lit(1)).alias("targets"), F.max("length").alias("longest"))
    out = t.join(b, "locus", "full").fillna(0, ["baits", "targets"])
    tiling = F.round(F.coalesce(F.try_divide(F.col("baits") * bait_length, F.col("longest")), F.lit(0.0)), 4)
    out = out.withColumn("tiling", tiling)
    return out.withColumn("removed", F.array_join(F.array_compact(F.array(F.when(F.col("baits") == 0, "no baits"), F.when(F.col("targets") == 0, "no targets"), F.when((F.col("baits") > 0) & (F.col("tiling") < min_tiling), "low tiling"))), ","))


def number_loci(frame: DataFrame, order: str) -> DataFrame:
    """Loci numbered by the order of their centroid, padded; the window has one row a locus."""
    loci = frame.select(order).distinct().withColumn("locus_no", F.lpad(F.row_number().over(Window.orderBy(order)).cast("string"), 6, "0"))
    return frame.join(loci, order)


def shuffled(frame: DataFrame, name: str, seed: int = 0) -> DataFrame:
    return frame.orderBy(F.xxhash64(name, F.lit(seed)), name)
