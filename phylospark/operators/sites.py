"""Alignments as sites: column statistics, trimming, paralog filters and matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators import streams

# Signs that count as missing data.
MISSING = {"NT": "?.~ONX#", "AA": "?.~*X#"}
AMBIGUOUS = {"NT": "MRWSYKVHDBN?", "AA": "BZJX?"}


#: Runs of kept sites up to which a row is cut run by run.
MANY_RUNS = 40


def _states(kind: str) -> str:
    return "ACGT" if kind == "NT" else "ACDEFGHIKLMNOPQRSTUVWY*"


def _holding(kind: str, state: str) -> list[str]:
    return [a for a, s in seq.letters(kind).items() if state in s and a != "-"]


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts of a column on end, and the length of each text."""
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    return np.frombuffer("".join(x or "" for x in column.to_pylist()).encode("utf-32-le"), np.uint32), sizes


def site_counts(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Residues per site and letter; terminal gaps are ``#``. Rows are shuffled whole and pass by locus, one at a time, in Arrow batches.

    Of a locus only the counts are held, so one of very many rows is a long stream; letters become no rows of their own.
    """
    rows = aln.select(*keys, seq.mark_terminal_gaps(F.upper("sequence")).alias("sequence"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # of the open locus: place and letter as one number, and how many
        last = None

        def summed() -> tuple[np.ndarray, np.ndarray]:
            at, back = np.unique(np.concatenate([a for a, _ in held]), return_inverse=True)
            return at, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)

        def closed() -> pa.RecordBatch:
            at, n = summed()
            own = [pa.array([v] * len(at), kind) for v, kind in zip(last, kinds, strict=True)]
            letters = [chr(c) for c in (at & 0x1FFFFF).tolist()]
            return pa.RecordBatch.from_arrays([*own, pa.array((at >> 21).astype(np.int32)), pa.array(letters, pa.string()), pa.array(n)], [*keys, "pos", "residue", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(k).type for k in keys]
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            starts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            letters, sizes = _letters(batch.column("sequence"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            places = (np.arange(len(letters)) - np.repeat(ends[:-1], sizes)) << 21 | letters
            for a, b in zip(starts, starts[1:], strict=False):
                if last is not None and names[a] != last:
                    yield closed()
                    held = []
                last = names[a]
                held.append(np.unique(places[ends[a] : ends[b]], return_counts=True))
                if len(held) >= 16:
                    held = [summed()]
        if last is not None:
            yield closed()

    return streams.by_group(rows, keys).mapInArrow(count, f"{fields}, pos int, residue string, n long")


def site_stats(counts: DataFrame, keys: list[str], kind: str = "NT") -> DataFrame:
    """Class, mean pairwise identity (with its number of pairs) and missing residues of every site.

    With p(r, b) the share of base b in letter r, the matches of all pairs are half of the sum over b of
    (sum of n p)^2 - sum of n p^2, so letters aren't joined with one another.
    """
    r, n = F.col("residue"), F.col("n")
    missing = r.isin(list(MISSING[kind]) + ["-"])
    sums = [F.sum(n).alias("rows"), F.sum(F.when(r != "#", n).otherwise(0)).alias("inner"), F.sum(F.when(r == "-", n).otherwise(0)).alias("gaps"), F.sum(F.when(missing, n).otherwise(0)).alias("missing")]
    states = _states(kind)
    for i, b in enumerate(states):
        share = F.lit(0.0)
        for a in _holding(kind, b):
            share = F.when(r == a, 1.0 / len(seq.letters(kind)[a])).otherwise(share)
        sums += [F.sum(n * share).alias(f"s{i}"), F.sum(n * share * share).alias(f"q{i}"), F.sum(F.when((share > 0) & ~missing, n).otherwise(0)).alias(f"c{i}")]
    out = counts.groupBy(*keys, "pos").agg(*sums)
    pairs = lambda x: x * (x - 1) / 2
    matches = sum((F.col(f"s{i}") * F.col(f"s{i}") - F.col(f"q{i}") for i in range(len(states))), F.lit(0.0)) / 2
    known = F.col("rows") - F.col("missing")
    held = [F.col(f"c{i}") for i in range(len(states))]
    constant = (known == 0) | (F.greatest(*held) == known)
    shared = sum((F.when(c >= 2, 1).otherwise(0) for c in held), F.lit(0))
    kind_of = F.when(constant, "constant").when(shared >= 2, "informative").otherwise("singleton")
    return out.select(*keys, "pos", "rows", "gaps", (F.col("rows") - F.col("inner")).alias("ends"), "missing", kind_of.alias("class"), F.when(F.col("inner") >= 2, matches).otherwise(0.0).alias("matches"), F.when(F.col("inner") >= 2, pairs(F.col("inner")) - pairs(F.col("gaps"))).otherwise(0.0).alias("pairs"))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that all bits of x went into."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_patterns(aln: DataFrame, keys: list[str], order: str, kind: str = "NT") -> DataFrame:
    """Number of distinct columns, compared by the summed hashes of (row name, residue), missing data as gaps.

    Rows pass by locus, as in ``site_counts``; of a locus 128 bits a site are held.
    """
    clean = F.translate(seq.mark_terminal_gaps(F.upper("sequence")), MISSING[kind], "-" * len(MISSING[kind]))
    rows = aln.select(*keys, F.xxhash64(order).alias("mark"), clean.alias("sequence"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums = None, np.zeros((2, 0), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, done = [batch.schema.field(k).type for k in keys], []
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            letters, sizes = _letters(batch.column("sequence"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            marks = batch.column("mark").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            low = _mixed(np.repeat(_mixed(marks), sizes) ^ letters.astype(np.uint64))
            both = np.vstack([low, _mixed(low + np.uint64(0x9E3779B97F4A7C15))])
            for i, name in enumerate(names):
                if name != last:
                    if last is not None:
                        done.append((*last, len(np.unique(sums, axis=1).T)))
                    last, sums = name, np.zeros((2, 0), np.uint64)
                if sizes[i] > sums.shape[1]:
                    sums = np.pad(sums, ((0, 0), (0, int(sizes[i]) - sums.shape[1])))
                sums[:, : sizes[i]] += both[:, ends[i] : ends[i + 1]]
            yield _counted(done, kinds)
        if last is not None:
            yield _counted([(*last, len(np.unique(sums, axis=1).T))], kinds)

    def _counted(done: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * (len(keys) + 1)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [*kinds, pa.int64()], strict=True)], [*keys, "patterns"])

    return streams.by_group(rows, keys).mapInArrow(count, f"{fields}, patterns long")


def gc_by_codon(aln: DataFrame, keys: list[str]) -> DataFrame:
    """GC percentage of each codon position, counted from the start of every ungapped sequence."""
    bare = F.regexp_replace(F.upper("sequence"), "-", "")
    parts = [seq.codon_position(bare, p) for p in (1, 2, 3)]
    return aln.groupBy(*keys).agg(*[F.round(F.try_divide(100.0 * F.sum(seq.gc_weight(p)), F.sum(seq.count_of(p, "ACGTMRWSYKVHDBN"))), 2).alias(f"gc_codon_p{i}") for i, p in enumerate(parts, 1)])


def copies(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Non-empty sequences of each sample, references left out."""
    own = aln.where(~F.col("is_ref") & (F.length(F.regexp_replace("sequence", "-", "")) > 0))
    return own.groupBy(*keys, "sample").agg(F.count(F.lit(1)).alias("copies"))


def copy_stats(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Samples and copies per locus, from counts of samples by their copies."""
    by = copies(aln, keys).groupBy(*keys, "copies").agg(F.count(F.lit(1)).alias("m"))
    return by.groupBy(*keys).agg(F.sum("m").alias("samples"), F.sum(F.col("copies") * F.col("m")).alias("total_copies"), F.expr("percentile(copies, 0.5, m)").alias("median_copies"))


def keep_loci(aln: DataFrame, keys: list[str], min_samples: int = 4, max_copies: float = -1) -> DataFrame:
    """Rows of the loci with enough samples and few enough copies."""
    good = copy_stats(aln, keys).where((F.col("samples") >= min_samples) & (F.lit(max_copies < 0) | (F.col("median_copies") <= max_copies)))
    return aln.join(good.select(*keys), keys, "left_semi")


def alignment_stats(aln: DataFrame, keys: list[str], kind: str = "NT", name: str = "seq_name") -> DataFrame:
    """All statistics of an alignment in one row a locus."""
    sites = site_stats(site_counts(aln, keys), keys, kind)
    of = lambda c: F.count_if(F.col("class") == c)
    main = sites.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sites"),
        of("informative").alias("informative"),
        of("constant").alias("constant"),
        of("singleton").alias("singleton"),
        F.round(100.0 * of("informative") / F.count(F.lit(1)), 2).alias("informativeness"),
        F.round(F.try_divide(100.0 * F.sum("matches"), F.sum("pairs")), 2).alias("mean_pid"),
        F.round(100.0 * F.sum("missing") / F.sum("rows"), 2).alias("missingness"),
    )
    bare = F.regexp_replace(F.upper("sequence"), "-", "")
    rows = aln.groupBy(*keys).agg(F.count(F.lit(1)).alias("sequences"), F.round(F.try_divide(100.0 * F.sum(seq.gc_weight(bare)), F.sum(seq.count_of(bare, "ACGTMRWSYKVHDBN"))), 2).alias("gc"))
    out = rows.join(main, keys).join(column_patterns(aln, keys, name, kind), keys).join(copy_stats(aln, keys).drop("total_copies"), keys, "left")
    return out.withColumn("mean_copies", F.round(F.try_divide(F.col("sequences"), F.col("samples")), 2))


def sample_stats(aln: DataFrame, keys: list[str], kind: str = "NT") -> DataFrame:
    """Means over a sample's copies of lengths, ambiguities and GC."""
    s = F.upper("sequence")
    bare = F.regexp_replace(s, "-", "")
    one = aln.select(*keys, "sample", F.length(s).alias("len_total"), F.length(F.regexp_replace(s, "^-+|-+$", "")).alias("len_gapped"), F.length(bare).alias("len_ungapped"), seq.count_of(bare, AMBIGUOUS[kind]).alias("ambigs"), seq.gc_percent(bare).alias("gc"))
    mean = lambda c: F.round(F.avg(c), 2).alias(c)
    return one.groupBy(*keys, "sample").agg(F.max("len_total").alias("len_total"), mean("len_gapped"), mean("len_ungapped"), mean("ambigs"), mean("gc"), F.count(F.lit(1)).alias("copies"))


def codon_sample_stats(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Means over a sample's copies of GC at each codon position."""
    bare = F.regexp_replace(F.upper("sequence"), "-", "")
    one = aln.select(*keys, "sample", *[seq.gc_percent(seq.codon_position(bare, p)).alias(f"gc_codon_p{p}") for p in (1, 2, 3)])
    return one.groupBy(*keys, "sample").agg(*[F.round(F.avg(f"gc_codon_p{p}"), 2).alias(f"gc_codon_p{p}") for p in (1, 2, 3)])


def full_sample_summary(aln: DataFrame, keys: list[str], kind: str = "NT") -> DataFrame:
    """The thirteen measures of a sample over all loci: lengths, gaps, ambiguities, GC by codon position, copies; references are left out."""
    own = aln.where(~F.col("is_ref"))
    per = sample_stats(own, keys, kind).join(codon_sample_stats(own, keys), [*keys, "sample"]).withColumn("gaps", F.col("len_gapped") - F.col("len_ungapped"))
    mean = lambda c, name: F.round(F.avg(c), 6).alias(name)
    return per.groupBy("sample").agg(
        F.count(F.lit(1)).alias("num_loci"), F.expr("percentile(len_ungapped, 0.5)").alias("median_len"), mean("len_ungapped", "mean_len"), F.round(F.sum("len_ungapped"), 2).alias("total_len"),
        mean("gaps", "mean_gaps"), F.round(F.sum("gaps"), 2).alias("total_gaps"), mean("ambigs", "mean_ambig"), mean("gc", "mean_gc"),
        *[mean(f"gc_codon_p{p}", f"mean_gc_codon{p}") for p in (1, 2, 3)], F.expr("percentile(copies, 0.5)").alias("median_copies"), mean("copies", "mean_copies"),
    )


def sample_summary(stats: DataFrame) -> DataFrame:
    """Per sample over all loci: numbers, total and mean lengths, GC, copies."""
    return stats.groupBy("sample").agg(F.count(F.lit(1)).alias("loci"), F.round(F.sum("len_ungapped"), 2).alias("total_length"), F.round(F.avg("len_gapped"), 4).alias("mean_len_gapped"), F.round(F.avg("gc"), 4).alias("mean_gc"), F.round(F.avg("copies"), 4).alias("mean_copies"), F.expr("percentile(copies, 0.5)").alias("median_copies"))


def keep_columns(aln: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Rows reduced to the kept sites; ``kept`` has an array of 0-based positions a locus."""
    joins = F.aggregate(
        F.array_sort("kept"),
        F.array().cast("array<struct<a:int,n:int>>"),
        lambda acc, p: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1).a + F.element_at(acc, -1).n == p),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1).a.alias("a"), (F.element_at(acc, -1).n + 1).alias("n")))),
        ).otherwise(F.concat(acc, F.array(F.struct(p.cast("int").alias("a"), F.lit(1).alias("n"))))),
    )
    cut = aln.join(kept.withColumn("__runs", joins), keys)
    by_runs = F.array_join(F.transform("__runs", lambda x: F.substring(F.col("sequence"), x.a + 1, x.n)), "")
    # of many runs letters are split once a row, as a substring costs time by its place
    picked = F.transform(F.array(F.split("sequence", "")), lambda letters: F.array_join(F.transform(F.array_sort("kept"), lambda p: F.get(letters, p)), ""))
    return cut.withColumn("sequence", F.when(F.size("__runs") <= MANY_RUNS, by_runs).otherwise(F.element_at(picked, 1))).drop("kept", "__runs")


def drop_empty_columns(aln: DataFrame, keys: list[str]) -> DataFrame:
    """Sites where every row has a gap are removed."""
    flat = aln.select(*keys, F.posexplode(F.split("sequence", "")).alias("pos", "residue")).where("residue <> '-'")
    kept = flat.select(*keys, "pos").distinct().groupBy(*keys).agg(F.collect_list("pos").alias("kept"))
    return keep_columns(aln, kept, keys)


def drop_short_rows(aln: DataFrame, keys: list[str], share: float = 0.3) -> DataFrame:
    """Rows whose ungapped length is under a share of the locus's median are removed; empty rows don't count."""
    own = aln.withColumn("__n", F.length(F.regexp_replace("sequence", "-", "")))
    median = own.where("__n > 0").groupBy(*keys, "__n").agg(F.count(F.lit(1)).alias("m")).groupBy(*keys).agg(F.expr("percentile(__n, 0.5, m)").alias("__median"))
    return own.join(median, keys).where(F.col("__n") >= share * F.col("__median")).drop("__n", "__median")


def trim_columns(aln: DataFrame, keys: list[str], mode: str = "gappy", gaps: float = 0.9, kind: str = "NT", codons: bool = False, min_data: int = 0) -> DataFrame:
    """Rows of the kept sites; see ``kept_columns``."""
    return keep_columns(aln, kept_columns(aln, keys, mode, gaps, kind, codons, min_data), keys)


def gap_threshold(rows: Column, min_data: int) -> Column:
    """Gap share at which ``min_data`` rows of a site have data: rounded to one place more than the rows have after their first digit."""
    share = 1 - F.least(rows, F.lit(min_data)) / rows
    digits = F.length(rows.cast("long").cast("string"))
    rounded = F.lit(None).cast("double")
    for d in range(1, 13):
        rounded = F.when(digits == d, F.bround(share, d)).otherwise(rounded)
    return F.when(rows == min_data, F.lit(1.0)).otherwise(rounded)


def kept_columns(aln: DataFrame, keys: list[str], mode: str = "gappy", gaps: float = 0.9, kind: str = "NT", codons: bool = False, min_data: int = 0) -> DataFrame:
    """Sites kept by gap share and class, as an array ``kept`` a locus.

    With ``min_data`` each locus's threshold is ``gap_threshold`` of its rows instead of ``gaps``.

    ``gappy``: gap share under ``gaps``; ``kpi``: informative; ``kpic``: informative or constant; either with
    ``-gappy`` for both. ``block-gappy``: only sites before the first and after the last good one go. With
    ``codons`` a codon stays whole if one of its sites does.
    """
    sites = site_stats(site_counts(aln, keys), keys, kind)
    full = (F.col("gaps") + F.col("ends")) / F.col("rows") <= (gap_threshold(F.col("rows"), min_data) if min_data > 0 else F.lit(gaps))
    informative, constant = F.col("class") == "informative", (F.col("class") == "constant") & (F.col("missing") < F.col("rows"))
    good = {"gappy": full, "block-gappy": full, "kpi": informative, "kpic": informative | constant, "kpi-gappy": informative & full, "kpic-gappy": (informative | constant) & full}[mode]
    sites = sites.withColumn("good", good)
    if mode == "block-gappy":
        ends = sites.where("good").groupBy(*keys).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
        return ends.select(*keys, F.sequence("lo", "hi").alias("kept"))
    chosen = sites.where("good")
    if codons:
        chosen = chosen.select(*keys, F.floor(F.col("pos") / 3).alias("codon")).distinct().select(*keys, F.explode(F.sequence((F.col("codon") * 3).cast("int"), (F.col("codon") * 3 + 2).cast("int"))).alias("pos"))
    return chosen.groupBy(*keys).agg(F.collect_list("pos").alias("kept"))


def trim_by_depth(aln: DataFrame, keys: list[str], gaps: float = 0.2, addons: DataFrame | None = None) -> DataFrame:
    """First and last site that enough rows span: ``floor(rows * (1 - gaps))`` of them.

    A row spans the sites between its first and its last residue, gaps inside included. Rows of the samples of
    ``addons`` neither count nor are counted on, and are cut like the others. Only the places where rows begin
    and end are counted, not every residue.
    """
    ends = aln.select(*keys, "sample", F.length(F.regexp_extract("sequence", "^(-*)", 1)).alias("first"), F.length(F.regexp_replace("sequence", "-+$", "")).alias("last"))
    if addons is not None:
        ends = ends.join(addons.select("sample").distinct(), "sample", "left_anti")
    rows = ends.groupBy(*keys).agg(F.floor(F.count(F.lit(1)) * (1 - gaps)).alias("least"))
    steps = ends.where("last > first").select(*keys, F.explode(F.array(F.struct(F.col("first").alias("pos"), F.lit(1).alias("step")), F.struct(F.col("last").alias("pos"), F.lit(-1).alias("step")))).alias("x"))
    counted = steps.groupBy(*keys, "x.pos").agg(F.sum("x.step").alias("step"))
    w = Window.partitionBy(*keys).orderBy("pos")
    spans = counted.withColumns({"depth": F.sum("step").over(w), "next": F.lead("pos").over(w)}).join(rows, keys).where(F.col("depth") >= F.col("least"))
    cut = spans.groupBy(*keys).agg(F.min("pos").alias("first"), F.max("next").alias("last"))
    whole = F.col("least") <= 0  # so few rows that no site is too thin
    cut = rows.join(cut, keys, "left").where(whole | F.col("first").isNotNull()).select(*keys, F.when(whole, 0).otherwise(F.col("first")).alias("first"), F.when(whole, 1 << 30).otherwise(F.col("last")).alias("last"))
    return aln.join(cut, keys).withColumn("sequence", F.substring(F.col("sequence"), F.col("first") + 1, F.col("last") - F.col("first"))).drop("first", "last")


def pairwise_identity(a: Column, b: Column, kind: str = "NT", skip_gaps: bool = False) -> Column:
    """Identity in percent over the overlap of two aligned sequences; ambiguity letters match in part.

    A pair of letters is looked up by their codes in a constant array, where -1 stands for pairs that don't count.
    """
    letters, low = sorted(seq.letters(kind)), 42
    values, size = {"".join(sorted(p)): v for p, v in seq.pair_identity(kind).items()}, 91 - low
    table = [-1.0] * (size * size)
    for x in letters:
        for y in letters:
            if (x, y) != ("-", "-") and not (skip_gaps and "-" in (x, y)):
                table[(ord(x) - low) * size + ord(y) - low] = float(values.get("".join(sorted(x + y)), 0.0))
    known = F.array(*map(F.lit, table))
    lead = lambda s: F.length(F.regexp_extract(s, "^(-*)", 1))
    end = lambda s: F.length(F.regexp_replace(s, "-+$", ""))
    first, last = F.greatest(lead(a), lead(b)), F.least(end(a), end(b))
    cut = lambda s: F.split(F.substring(F.upper(s), first + 1, F.greatest(last - first, F.lit(0))), "")
    value = lambda x, y: F.coalesce(F.get(known, (F.ascii(x) - low) * size + F.ascii(y) - low), F.lit(-1.0))
    step = lambda acc, v: F.struct((acc.m + F.greatest(v, F.lit(0.0))).alias("m"), (acc.n + F.when(v >= 0, 1).otherwise(0)).alias("n"))
    total = F.aggregate(F.zip_with(cut(a), cut(b), value), F.struct(F.lit(0.0).alias("m"), F.lit(0).alias("n")), step, lambda acc: F.coalesce(F.try_divide(100.0 * acc.m, acc.n), F.lit(0.0)))
    return F.when(last > first, total).otherwise(0.0)


def filter_paralogs_naive(aln: DataFrame, keys: list[str], min_samples: int = 4) -> DataFrame:
    """Each sample's best copy and all references, in loci with enough samples."""
    return keep_loci(aln.where(F.col("is_ref") | (F.col("rank") == 0)), keys, min_samples)


def filter_paralogs_informed(aln: DataFrame, refs: DataFrame, keys: list[str], tolerance: float = -1, kind: str = "NT") -> DataFrame:
    """Each copy with its identity to the locus's most chosen reference, score, and whether it is accepted.

    The reference that best copies name most often is the model; a sample's copy with the highest
    identity^2 * sqrt(length share) is accepted, unless its identity lies ``tolerance`` deviations under the mean.
    """
    chosen = aln.where(~F.col("is_ref") & (F.col("rank") == 0)).groupBy(*keys, "target").agg(F.count(F.lit(1)).alias("n"))
    model = chosen.groupBy(*keys).agg(F.min_by("target", F.struct(-F.col("n"), F.col("target"))).alias("target"))
    best = model.join(refs.select(*keys, "target", F.col("sequence").alias("ref_sequence")), [*keys, "target"])
    own = aln.where(~F.col("is_ref")).drop("target").join(best, keys)
    bare = lambda c: F.length(F.regexp_replace(c, "^-+|-+$", ""))
    own = own.withColumn("pid", F.round(pairwise_identity(F.col("ref_sequence"), F.col("sequence"), kind, skip_gaps=True), 5))
    share = F.coalesce(F.try_divide(bare("sequence"), bare("ref_sequence")), F.lit(0.0))
    own = own.withColumn("score", F.round(F.pow(F.col("pid") / 100, F.lit(2)) * F.sqrt(share), 5))
    first = F.row_number().over(Window.partitionBy(*keys, "sample").orderBy(F.desc("score"), "rank", "seq_name")) == 1
    own = own.withColumn("first", first)
    limit = own.where("first").groupBy(*keys).agg((F.avg("pid") - tolerance * F.stddev_samp("pid")).alias("least"))
    out = own.join(limit, keys)
    passed = F.lit(tolerance == -1) | F.coalesce(F.col("pid") >= F.col("least"), F.lit(True))
    return out.select(*keys, "sample", "seq_name", "target", "pid", "score", (F.col("first") & passed).alias("accepted"))


def apply_accepted(rows: DataFrame, judged: DataFrame, keys: list[str], files: list[str], min_samples: int = 4) -> DataFrame:
    """Accepted copies and references in every format of a locus, under names without rank, where enough samples are left.

    ``judged`` is what ``filter_paralogs_informed`` says of the copies of one format; ``rows`` hold all formats, of which ``files`` (with
    the locus) names one file. Copies that weren't judged go, as rejected ones do.
    """
    accepted = judged.where("accepted").select(*keys, "seq_name").distinct()
    kept = rows.where("is_ref").unionByName(rows.where("not is_ref").join(accepted, [*keys, "seq_name"], "left_semi"))
    enough = kept.where("not is_ref").groupBy(*files).agg(F.count_distinct("sample").alias("n")).where(F.col("n") >= min_samples)
    named = F.when(F.col("is_ref") | ~F.col("seq_name").contains("__"), F.col("seq_name")).otherwise(F.regexp_replace("seq_name", "__[^_]*$", ""))
    return kept.join(enough.select(*files), files, "left_semi").withColumn("seq_name", named)


def add_references(aln: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The references that a locus's rows name, each once, beside those it has."""
    needed = aln.where(~F.col("is_ref")).select(*keys, "target").distinct()
    return needed.join(targets, [*keys, "target"]).select(*keys, "target", "sequence").dropDuplicates([*keys, "target"])


def remove_references(aln: DataFrame, names: DataFrame) -> DataFrame:
    """Rows that aren't in a list of reference names."""
    return aln.join(names, "seq_name", "left_anti")


def supermatrix(aln: DataFrame, sample: str = "sample", locus: str = "locus") -> DataFrame:
    """One concatenated row a sample over all loci in order, absent loci as gaps.

    A sample's loci gather in its row, which is what a supermatrix is; lengths come from the short list of loci.
    """
    lengths = aln.groupBy(locus).agg(F.max(F.length("sequence")).alias("width"))
    grid = lengths.agg(F.array_sort(F.collect_list(F.struct(F.col(locus).alias("l"), F.col("width").alias("w")))).alias("loci"))
    best = aln.groupBy(sample, locus).agg(F.min_by("sequence", F.struct("rank", "seq_name")).alias("s"))
    rows = best.groupBy(sample).agg(F.map_from_entries(F.collect_list(F.struct(locus, "s"))).alias("own"), F.count(F.lit(1)).alias("loci_present"))
    parts = F.transform("loci", lambda x: F.coalesce(F.element_at("own", x.l), F.repeat(F.lit("-"), x.w)))
    return rows.withColumn("loci", grid.scalar()).select(sample, "loci_present", F.array_join(parts, "").alias("sequence"))


def partitions(lengths: DataFrame, codon: str = "") -> DataFrame:
    """Start and end of every locus in a supermatrix, and its text for partition files.

    The window runs over one row a locus, of which there are thousands at most.
    """
    w = Window.orderBy("locus").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = lengths.withColumn("end", F.sum("width").over(w)).withColumn("start", F.col("end") - F.col("width") + 1)
    span = lambda shift, step: F.concat((F.col("start") + shift).cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(step))
    text = {"": span(0, ""), "12": F.concat_ws(" ", span(0, "\\3"), span(1, "\\3")), "123": F.concat_ws(" ", span(0, "\\3"), span(1, "\\3"), span(2, "\\3"))}[codon]
    return out.select("locus", "start", "end", text.alias("sites"))


def sequence_to_sample(aln: DataFrame) -> DataFrame:
    """Names of all copies up to each sample's highest rank, with the sample."""
    top = aln.where(~F.col("is_ref")).groupBy("sample").agg(F.max("rank").alias("top"))
    names = top.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("top"))))
    copies_ = names.select(F.concat_ws("__", "sample", F.lpad(F.col("i").cast("string"), 2, "0")).alias("name"), "sample")
    return top.select(F.col("sample").alias("name"), "sample").union(copies_)


def codon_align(protein: Column, bases: Column) -> Column:
    """Codons laid out along an aligned protein; a gap is three gaps.

    Residues between gaps are laid out as one piece, so a row costs time by its length and its gaps.
    """
    runs = F.regexp_extract_all(protein, F.lit("-+|[^-]+"), F.lit(0))
    start = F.struct(F.lit(0).alias("used"), F.lit("").alias("out"))

    def lay(acc: Column, run: Column) -> Column:
        gap = run.startswith("-")
        piece = F.when(gap, F.repeat(F.lit("---"), F.length(run))).otherwise(F.substring(bases, acc.used + 1, 3 * F.length(run)))
        return F.struct((acc.used + F.when(gap, 0).otherwise(3 * F.length(run))).alias("used"), F.concat(acc.out, piece).alias("out"))

    return F.aggregate(runs, start, lay, lambda acc: acc.out)
