"""Similarity by shared k-mers: read assignment, seed hits, clustering, masking and thinning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phylospark.functions import seq
from phylospark.operators import shared, streams
from phylospark.operators import targets as bits


#: Sequences are cut into stretches of about this length before their windows, as a substring costs time by its place.
STRETCH = 600


def kmers(frame: DataFrame, keep: list[str], k: int, step: int = 1, sequence: str = "sequence") -> DataFrame:
    """(keep, pos, kmer): all k-mers of upper-case sequences, ``step`` apart, from place 1."""
    s, size = F.upper(sequence), -(-STRETCH // step) * step
    pieces = F.transform(F.sequence(F.lit(1), F.length(s) - (k - 1), F.lit(size)), lambda i: F.substring(s, i, F.lit(size + k - 1)))
    cut = frame.where(F.length(sequence) >= k).select(*keep, F.posexplode(pieces).alias("__p", "__s"))
    piece = F.col("__s")
    windows = F.transform(F.sequence(F.lit(1), F.length(piece) - (k - 1), F.lit(step)), lambda i: F.struct((F.col("__p") * size + i).alias("pos"), F.substring(piece, i, F.lit(k)).alias("kmer")))
    return cut.select(*keep, F.explode(windows).alias("x")).select(*keep, "x.pos", "x.kmer")


#: Letters whose windows are hashed at a time, which bounds what a task holds for it to some 50 MB.
LETTERS = 1 << 20


def window_keys(texts: list[str], k: int, step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every ``step``-th k-mer of texts: the text's number, the place from 0 and 64 bits of a hash of its code points."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    n = np.maximum((sizes - k) // step + 1, 0)
    row = np.repeat(np.arange(len(texts)), n)
    pos = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step
    whole = np.zeros(max(0, len(raw) - k + 1), np.uint64)
    for i, by in enumerate(bits._mixed(np.arange(1, k + 1, dtype=np.uint64), 0xBF58476D1CE4E5B9)):
        whole += raw[i : i + len(whole)] * (by | np.uint64(1))
    return row, pos, whole[pos + np.repeat(np.cumsum(sizes) - sizes, n)]


def _pieces(texts: list[str], k: int, step: int) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, place of the first text in it, texts) with some LETTERS each; long texts are cut, their cuts overlap."""
    held, first, size, stride = [], 0, 0, -(-LETTERS // step) * step
    for i, text in enumerate(texts):
        if len(text) > LETTERS:
            if held:
                yield first, 0, held
            yield from ((i, at, [text[at : at + stride + k - 1]]) for at in range(0, len(text) - k + 1, stride))
            held, first, size = [], i + 1, 0
            continue
        held.append(text)
        size += len(text)
        if size > LETTERS:
            yield first, 0, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, 0, held


def kmers_among(frame: DataFrame, keep: list[str], k: int, wanted: DataFrame, step: int = 1) -> DataFrame:
    """``kmers`` of ``frame``, those that texts in ``wanted`` (``sequence``) have too, and few others.

    A filter of the wanted k-mers goes to the tasks, 64 MB at most, so only k-mers in it become rows. What it lets through by mistake meets
    nothing in the join that follows; past some 50 million wanted k-mers that is more.
    """
    texts = lambda f, *cols: f.where(F.length("sequence") >= k).select(*cols, F.upper("sequence").alias("__text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, own in _pieces(batch.column("__text").to_pylist(), k, 1):
                a = np.unique(window_keys(own, k)[2]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.zeros_like(a))], ["a", "b"])

    letters = wanted.agg(F.sum(F.length("sequence"))).first()[0] or 0
    size = min(bits.FILTER, max(bits.PART, int(16 * letters).bit_length()))
    held = frame.sparkSession.sparkContext.broadcast(bits._filter(texts(wanted).mapInArrow(keys, "a long, b long"), size))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = held.value
        for batch in batches:
            for first, start, own in _pieces(batch.column("__text").to_pylist(), k, step):
                row, pos, key = window_keys(own, k, step)
                one, other = bits._places(key, size)
                at = np.flatnonzero((found[one >> 3] >> (one & 7)) & (found[other >> 3] >> (other & 7)) & 1)
                row, pos = row[at], pos[at]
                texts_ = [own[r][p : p + k] for r, p in zip(row.tolist(), pos.tolist(), strict=True)]
                kept = [batch.column(c).take(pa.array(row + first)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array((pos + start + 1).astype(np.int32)), pa.array(texts_, pa.string())], [*keep, "pos", "kmer"])

    schema = T.StructType([*frame.select(*keep).schema, T.StructField("pos", T.IntegerType()), T.StructField("kmer", T.StringType())])
    return texts(frame, *keep).mapInArrow(find, schema)


def assign_reads(reads: DataFrame, contigs: DataFrame, k: int = 31, step: int = 10) -> DataFrame:
    """Reads of either strand per contig of the same sample by k-mer votes; a read that ties between contigs is shared among them."""
    either = canonical(F.col("kmer")).alias("kmer")
    own = kmers(reads, ["sample", "read_id"], k, step).select("sample", "read_id", either)
    ref = kmers(contigs, ["sample", "contig"], k).select("sample", "contig", either).distinct()
    votes = own.join(ref, ["sample", "kmer"]).groupBy("sample", "read_id", "contig").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("sample", "read_id")
    best = votes.withColumn("top", F.max("votes").over(w)).where("votes = top").withColumn("share", 1.0 / F.count(F.lit(1)).over(w))
    return best.groupBy("sample", "contig").agg(F.round(F.sum("share"), 6).alias("num_reads"))


def seed_hits(targets: DataFrame, contigs: DataFrame, k: int = 15, min_seeds: int = 3) -> DataFrame:
    """Ungapped hits of targets on contigs: seeds on one diagonal, with their span and number."""
    met = kmers(targets, ["target"], k).withColumnRenamed("pos", "q").join(kmers_among(contigs, ["contig"], k, targets).withColumnRenamed("pos", "t"), "kmer")
    out = met.groupBy("target", "contig", (F.col("t") - F.col("q")).alias("diagonal")).agg(F.count(F.lit(1)).alias("seeds"), (F.min("q") - 1).alias("q_start"), (F.max("q") + (k - 1)).alias("q_end"))
    return out.where(F.col("seeds") >= min_seeds).withColumns({"t_start": F.col("q_start") + F.col("diagonal"), "t_end": F.col("q_end") + F.col("diagonal")})


def _placed(hits: DataFrame, strand: Column, start: Column, end: Column) -> DataFrame:
    size = F.col("contig.length")
    minus = strand == "-"
    places = {"t_start": F.when(minus, size - end).otherwise(start), "t_end": F.when(minus, size - start).otherwise(end)}
    return hits.withColumns({"strand": strand, **places})


def seed_hits_on_both_strands(targets: DataFrame, contigs: DataFrame, k: int = 15, min_seeds: int = 3) -> DataFrame:
    """``seed_hits`` of targets on contigs and on their reverse complements, in places of the contig as it is."""
    own = contigs.select("contig", F.length("sequence").alias("length"), F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.upper("sequence").alias("s")), F.struct(F.lit("-").alias("strand"), seq.reverse_complement(F.upper("sequence")).alias("s")))).alias("x"))
    own = own.select(F.struct("contig", "length", "x.strand").alias("contig"), F.col("x.s").alias("sequence"))
    out = _placed(seed_hits(targets, own, k, min_seeds), F.col("contig.strand"), F.col("t_start"), F.col("t_end"))
    return out.select("target", F.col("contig.contig").alias("contig"), "strand", "diagonal", "seeds", "q_start", "q_end", "t_start", "t_end")


def translated_hits(proteins: DataFrame, contigs: DataFrame, k: int = 7, min_seeds: int = 3, code: int = 1) -> DataFrame:
    """Ungapped hits of protein targets on the six translations of contigs, in places of the contig's bases."""
    frames = (1, 2, 3, -1, -2, -3)
    tried = F.explode(F.array(*[F.struct(F.lit(f).alias("frame"), seq.translate(F.col("sequence"), code, f).alias("s")) for f in frames])).alias("x")
    own = contigs.select("contig", F.length("sequence").alias("length"), tried).select(F.struct("contig", "length", "x.frame").alias("contig"), F.col("x.s").alias("sequence"))
    shift, frame = F.abs("contig.frame") - 1, F.col("contig.frame")
    out = _placed(seed_hits(proteins, own, k, min_seeds), F.when(frame < 0, "-").otherwise("+"), 3 * F.col("t_start") + shift, 3 * F.col("t_end") + shift)
    return out.select("target", F.col("contig.contig").alias("contig"), frame.alias("frame"), "diagonal", "seeds", "q_start", "q_end", "t_start", "t_end")


def colinear_hits(seeds: DataFrame, max_shift: int = 50) -> DataFrame:
    """Hits of near diagonals joined: block starts and sizes in order, matches and inserts, as hit rows."""
    w = Window.partitionBy("target", "contig").orderBy("diagonal")
    jump = F.when(F.col("diagonal") - F.lag("diagonal").over(w) > max_shift, 1).otherwise(0)
    chained = seeds.withColumn("jump", jump).withColumn("chain", F.sum("jump").over(w))
    block = F.struct("t_start", "q_start", (F.col("q_end") - F.col("q_start")).alias("size"))
    out = chained.groupBy("target", "contig", "chain").agg(F.array_sort(F.collect_list(block)).alias("blocks"), F.min("q_start").alias("q_start"), F.max("q_end").alias("q_end"), F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end"), F.sum("seeds").alias("seeds"))
    return out.select("target", "contig", "q_start", "q_end", "t_start", "t_end", "seeds", F.size("blocks").alias("block_count"), F.transform("blocks", lambda b: b.size).alias("block_sizes"), F.transform("blocks", lambda b: b.q_start).alias("q_starts"), F.transform("blocks", lambda b: b.t_start).alias("t_starts"))


def canonical(s: Column) -> Column:
    """The lesser of a sequence and its reverse complement."""
    return F.least(F.upper(s), seq.reverse_complement(F.upper(s)))


def deduplicate(seqs: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Equal sequences of a group on either strand once, under the first name."""
    return seqs.groupBy(*keys, canonical(F.col("sequence")).alias("canonical")).agg(F.min_by(F.struct(name, "sequence"), name).alias("x"), F.count(F.lit(1)).alias("copies")).select(*keys, f"x.{name}", "x.sequence", "copies")


def _edges(seqs: DataFrame, keys: list[str], identity: float, coverage: float, k: int, name: str, save) -> DataFrame:
    """Pairs whose shared k-mers reach ``coverage`` of the shorter set and, by the Mash formula, ``identity``: both bounds are one share of the smaller set."""
    return shared.pairs_by_share(seqs, keys, max(coverage / 100.0, (identity / 100.0) ** k), k, name, save)


def cluster_sequences(seqs: DataFrame, keys: list[str] = (), identity: float = 75.0, coverage: float = 50.0, k: int = 11, name: str = "name", save=None) -> DataFrame:
    """Greedy clusters: members meet identity and coverage with their centroid; longer sequences lead.

    Equal sequences are one from the start and share a centroid. In rounds, a sequence that is the longest among
    its open neighbours becomes a centroid and takes them; rounds end when none is open. Among sequences of one length a hash
    of the name decides, so a chain of neighbours takes few rounds. All pairs are compared (see ``pairs_by_share``).
    Sequences shorter than ``k`` stay alone. ``save`` writes a frame out and reads it back to cut its lineage.
    """
    keys = list(keys)
    save = save or (lambda f: f.checkpoint())
    text = F.upper("sequence")
    lead = save(seqs.groupBy(*keys, text.alias("sequence")).agg(F.min(name).alias("lead")))
    mark = F.sha2(text, 256).alias("mark")  # texts are shuffled once; copies meet their lead by it
    copies = save(seqs.select(*keys, name, mark).join(lead.select(*keys, "lead", mark), [*keys, "mark"]).select(*keys, F.col("lead").alias("member"), F.col(name).alias("copy")))
    seqs = lead.withColumnRenamed("lead", name)
    edges = save(_edges(seqs, keys, identity, coverage, k, name, save))
    both = save(edges.select(*keys, F.col(name).alias("a"), F.col("other").alias("b")).union(edges.select(*keys, F.col("other").alias("a"), F.col(name).alias("b"))))
    whole = seqs.select(*keys, F.col(name).alias("a"), F.struct((-F.length("sequence")).alias("l"), F.xxhash64(name).alias("h")).alias("p"))
    linked = both.select(*keys, "a").distinct()
    done = save(whole.join(linked, [*keys, "a"], "left_anti").select(*keys, F.col("a").alias("centroid"), F.col("a").alias("member")))
    open_ = save(whole.join(linked, [*keys, "a"], "left_semi"))
    while open_.limit(1).count():
        order = F.struct("p", "a")
        near = both.join(open_.withColumnRenamed("a", "b").withColumn("o", F.struct("p", "b")).drop("p"), [*keys, "b"])
        best = near.groupBy(*keys, "a").agg(F.min("o").alias("o"))
        judged = open_.join(best, [*keys, "a"], "left")
        lead = judged.where(F.col("o").isNull() | (order < F.struct(F.col("o.p").alias("p"), F.col("o.b").alias("a")))).select(*keys, "a", "p")
        taken = lead.join(both, [*keys, "a"]).join(open_.select(*keys, F.col("a").alias("b")), [*keys, "b"]).groupBy(*keys, "b").agg(F.min(F.struct("p", "a")).alias("c")).select(*keys, F.col("c.a").alias("centroid"), F.col("b").alias("member"))
        new = save(taken.union(lead.select(*keys, F.col("a").alias("centroid"), F.col("a").alias("member"))))
        done = done.union(new)
        open_ = save(open_.join(new.select(*keys, F.col("member").alias("a")), [*keys, "a"], "left_anti"))
    return done.join(copies, [*keys, "member"]).select(*keys, "centroid", F.col("copy").alias("member"))


def deduplicate_near(seqs: DataFrame, keys: list[str], identity: float = 99.0, coverage: float = 80.0, k: int = 21, name: str = "name", save=None) -> DataFrame:
    """One sequence of each near-equal group, the longest, on either strand: ``deduplicate``, then clusters at ``identity`` by shared k-mers."""
    one = deduplicate(seqs, keys, name).withColumn("sequence", canonical(F.col("sequence")))
    groups = cluster_sequences(one.select(*keys, name, "sequence"), keys, identity, coverage, k, name, save)
    sizes = groups.join(one.select(*keys, F.col(name).alias("member"), "copies"), [*keys, "member"]).groupBy(*keys, F.col("centroid").alias(name)).agg(F.sum("copies").alias("copies"))
    return seqs.select(*keys, name, "sequence").join(sizes, [*keys, name])


def thin_clustered_baits(baits: DataFrame, identity: float = 98.0, overlap: float = 50.0, bait_length: int = 120, k: int = 15, save=None) -> DataFrame:
    """Baits (``name``, ``sequence``) that lead clusters: a bait goes if a leading one shares ``overlap`` percent of its columns at ``identity``."""
    least = 100.0 * max(1, round(bait_length * overlap / 100) - (k - 1)) / (bait_length - (k - 1))
    groups = cluster_sequences(baits, [], identity, least, k, "name", save)
    return baits.join(groups.select(F.col("centroid").alias("name")).distinct(), "name", "left_semi")


def strand_votes(seqs: DataFrame, clusters: DataFrame, k: int = 15, name: str = "name") -> DataFrame:
    """Whether a member shares more k-mers with its centroid as it is or reversed.

    Sequences pass by cluster, the centroid first; of the open cluster the centroid's k-mers are held, and no k-mer becomes a row.
    """
    lead = clusters.select("centroid").distinct().join(seqs.select(F.col(name).alias("centroid"), "sequence"), "centroid")
    own = clusters.select("centroid", "member").distinct().join(seqs.select(F.col(name).alias("member"), "sequence"), "member")
    rows = lead.select("centroid", F.lit(None).cast(own.schema["member"].dataType).alias("member"), "sequence", F.lit(0).alias("turn")).unionByName(own.withColumn("turn", F.lit(1)))
    both = F.array(F.upper("sequence"), F.upper(seq.reverse_complement(F.col("sequence")))).alias("texts")
    ordered = streams.by_group(rows, ["centroid"], "turn").select("centroid", "member", "turn", both)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, set()
        for batch in batches:
            at, plus, minus = [], [], []
            for i, (centroid, turn, texts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("centroid", "turn", "texts")), strict=True)):
                ahead, back = (x or "" for x in texts)
                if centroid != group:
                    group, held = centroid, set()
                if not turn:
                    held = {ahead[j : j + k] for j in range(len(ahead) - k + 1)}
                    continue
                at.append(i)
                for text, votes in ((ahead, plus), (back, minus)):
                    votes.append(sum(text[j : j + k] in held for j in range(len(text) - k + 1)))
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("centroid", "member")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(plus, pa.int64()), pa.array(minus, pa.int64())], ["centroid", "member", "plus", "minus"])

    schema = T.StructType([*ordered.select("centroid", "member").schema, T.StructField("plus", T.LongType()), T.StructField("minus", T.LongType())])
    out = clusters.join(ordered.mapInArrow(vote, schema), ["centroid", "member"], "left").fillna(0, ["plus", "minus"])
    return out.withColumn("strand", F.when(F.col("minus") > F.col("plus"), "-").otherwise("+"))


def triplet_scores(letters: np.ndarray) -> np.ndarray:
    """Repetitiveness of each row of letters' codes: pairs of equal triplets over the number of triplets less one."""
    rows, n = letters.shape[0], letters.shape[1] - 2
    kinds, c = np.unique(letters, return_inverse=True) if letters.max() >= 128 else _ranks(letters)
    c, size = c.reshape(letters.shape).astype(np.int64), len(kinds)
    t = (c[:, :-2] * size + c[:, 1:-1]) * size + c[:, 2:]
    if size**3 <= 8 * n:
        counts = np.bincount((t + np.arange(rows)[:, None] * size**3).ravel(), minlength=rows * size**3).reshape(rows, -1)
        return ((counts * counts).sum(axis=1) - n) / 2 / (n - 1)
    t = np.sort(t, axis=1)
    at = np.arange(n)
    run = at - np.maximum.accumulate(np.where(np.pad(t[:, 1:] != t[:, :-1], ((0, 0), (1, 0)), constant_values=True), at, 0), axis=1)
    return run.sum(axis=1) / (n - 1)


def _ranks(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of codes under 128 and each code's place among them."""
    held = np.bincount(letters.ravel(), minlength=128) > 0
    return np.flatnonzero(held), (np.cumsum(held) - 1)[letters]


def mask_low_complexity(baits: DataFrame, column: str = "bait", window: int = 40, step: int = 20, limit: float = 2.0) -> DataFrame:
    """Windows whose triplets repeat too much in lower case. Baits of one length are judged together, a batch at a time."""

    @F.pandas_udf("string")
    def masked(baits_: pd.Series) -> pd.Series:
        out = baits_.to_numpy(object, copy=True)
        sizes = baits_.str.len().fillna(0).to_numpy(int)
        for n in np.unique(sizes[sizes > 3]):
            rows = np.flatnonzero(sizes == n)
            letters = np.frombuffer("".join(out[rows]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
            bad = [(s, triplet_scores(letters[:, s : s + window]) > limit) for s in range(0, max(1, n - window + 1), step)]
            for i in np.flatnonzero(np.any([x for _, x in bad], axis=0)):
                text = out[rows[i]]
                for s, is_bad in bad:
                    if is_bad[i]:
                        text = text[:s] + text[s : s + window].lower() + text[s + window :]
                out[rows[i]] = text
        return pd.Series(out)

    return baits.withColumn(column, masked(F.upper(column)))


def thin_baits(baits: DataFrame, bait_length: int = 120, overlap: float = 50.0, step: int = 1) -> DataFrame:
    """Baits of a sequence so far apart that neighbours overlap by ``overlap`` percent at most, from the first on.

    ``step`` is the distance at which they were tiled.
    """
    apart = max(1, round(bait_length * (1 - overlap / 100) / step))
    return baits.where((F.col("bait_no") - 1) % apart == 0)


def exonic(baits: DataFrame, exons: DataFrame, k: int = 31) -> DataFrame:
    """Baits, on either strand, whose first and last k-mer both lie in one exon, on one diagonal: those that map without a clip."""
    def either(s: Column, turned: Column, at: Column, n: Column) -> Column:
        """First and last k-mer of the n bases from ``at``, on the strand that makes them least."""
        pair = lambda x, i: F.struct(F.substring(x, i, F.lit(k)).alias("first"), F.substring(x, i + n - k, F.lit(k)).alias("last"))
        return F.least(pair(s, at), pair(turned, F.length(s) - at - n + 2))

    b, n = F.upper("bait"), F.length("bait")
    own = baits.where(n >= k).withColumns({"__n": n, "__ends": either(b, seq.reverse_complement(b), F.lit(1), n)})
    # an exon gives its pairs of ends at each length of baits, so frequent k-mers make no pairs of baits and exons
    sized = exons.select(F.upper("sequence").alias("s")).crossJoin(F.broadcast(own.select("__n").distinct())).where(F.length("s") >= F.col("__n"))
    starts = F.sequence(F.lit(1), F.length("s") - F.col("__n") + 1, F.lit(STRETCH))
    cut = sized.select("__n", F.explode(F.transform(starts, lambda i: F.substring(F.col("s"), i, F.col("__n") + (STRETCH - 1)))).alias("s"))
    cut = cut.withColumn("turned", seq.reverse_complement(F.col("s")))
    places = F.sequence(F.lit(1), F.length("s") - F.col("__n") + 1)
    ends = F.transform(places, lambda i: either(F.col("s"), F.col("turned"), i, F.col("__n")))
    ref = cut.select("__n", F.explode(ends).alias("__ends")).distinct()
    return own.join(ref, ["__n", "__ends"], "left_semi").select(*baits.columns)
