"""Gapped similarity search: shared k-mers, chains of them by a sparse dynamic program, and banded affine alignment between and beyond."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators.hits import hit_identity
from phylospark.operators.similarity import kmers, kmers_among

#: Scores of an alignment: a match, a mismatch, a gap of n bases costs OPEN + n * EXTEND.
MATCH, MISMATCH, OPEN, EXTEND = 1, -1, 2, 1
#: Diagonals beside the straight one that an alignment may use, and by how much a path's score may fall before it ends.
BAND, DROP = 32, 25
#: Runs of seeds before one that are looked at as its predecessor in a chain.
BACK = 256
#: Rows of one k-mer that meet the other side in one task.
FREQUENT = 1 << 15
LOW = -(1 << 28)


def banded(q: np.ndarray, t: np.ndarray, low: int, high: int, whole: bool) -> tuple[int, list[tuple[int, int, int]]]:
    """Best affine alignment from (0, 0) over the diagonals ``low`` to ``high`` (place in t less place in q): its score and its
    blocks (q, t, size). To the far corner with ``whole``, else to the best cell, given up once the score has fallen by DROP."""
    n, m, width = len(q), len(t), high - low + 1
    d = np.arange(low, high + 1)
    first = (d >= 0) & (d <= m)
    gap_t = np.where(first & (d > 0), -OPEN - EXTEND * d, LOW)  # ends in a gap that takes letters of t
    best = np.where(d == 0, 0, gap_t)
    gap_q = np.full(width, LOW)
    steps = np.zeros((n + 1, width), np.uint8)  # 1 and 2: the best is a gap in t's or q's letters; 4 and 8: that gap was longer
    steps[0] = np.where(d > 0, 1 | np.where(d > 1, 4, 0), 0)
    top, at, slope = 0, (0, -low), EXTEND * np.arange(width)
    for i in range(1, n + 1):
        j = d + i
        inside = (j >= 1) & (j <= m)
        same = np.zeros(width, bool)
        same[inside] = t[j[inside] - 1] == q[i - 1]
        straight = np.where(inside, best + np.where(same, MATCH, MISMATCH), LOW)
        opened, longer = np.append(best[1:], LOW) - OPEN - EXTEND, np.append(gap_q[1:], LOW) - EXTEND
        gap_q = np.where((j >= 0) & (j <= m), np.maximum(opened, longer), LOW)
        new = np.maximum(straight, gap_q)
        ahead = np.maximum.accumulate(new + slope)  # a gap that takes letters of t begins at any cell before
        gap_t = np.full(width, LOW)
        gap_t[1:] = np.where(j[1:] <= m, ahead[:-1] - slope[1:] - OPEN, LOW)
        both = np.maximum(new, gap_t)
        gap_longer = np.zeros(width, bool)
        gap_longer[2:] = gap_t[2:] == gap_t[1:-1] - EXTEND
        steps[i] = np.where(both == straight, 0, np.where(both == gap_q, 2, 1)) | np.where(gap_longer, 4, 0) | np.where(longer > opened, 8, 0)
        best = np.maximum(both, LOW)
        if not whole:
            c = int(best.argmax())
            if best[c] > top:
                top, at = int(best[c]), (i, c)
            elif best[c] < top - DROP:
                break
    i, c = (n, m - n - low) if whole else at
    score, blocks, state = int(best[c]) if whole else top, [], 0
    while i or c + low:
        state = state or int(steps[i, c]) & 3
        if state == 0:
            if blocks and blocks[-1][:2] == (i, i + c + low):
                blocks[-1] = (i - 1, i - 1 + c + low, blocks[-1][2] + 1)
            else:
                blocks.append((i - 1, i - 1 + c + low, 1))
            i -= 1
        elif state == 1:
            state = 1 if steps[i, c] & 4 else 0
            c -= 1
        else:
            state = 2 if steps[i, c] & 8 else 0
            i, c = i - 1, c + 1
    return score, blocks[::-1]


def filled(q: np.ndarray, t: np.ndarray) -> list[tuple[int, int, int]]:
    """Blocks between two anchors: a banded alignment, or, where one side is much longer, both anchors extended towards one gap."""
    n, m = len(q), len(t)
    if not n or not m:
        return []
    if abs(m - n) <= BAND:
        return banded(q, t, min(0, m - n) - BAND // 2, max(0, m - n) + BAND // 2, True)[1]
    size = min(n, m)
    left = np.append(0, np.cumsum(q[:size] == t[:size]))
    right = np.append(0, np.cumsum(q[::-1][:size] == t[::-1][:size]))
    cut = int((left + right[::-1]).argmax())
    return [b for b in ((0, 0, cut), (n - size + cut, m - size + cut, size - cut)) if b[2]]


def chained(q: np.ndarray, t: np.ndarray, size: np.ndarray) -> list[int]:
    """The best chain of runs, which come by their place on t: each after the one before on both sequences, changes of diagonal cost."""
    score, before, end = size.astype(float), np.full(len(q), -1), np.empty(len(q))
    shift = t - q
    for j in range(len(q)):
        i = np.arange(max(0, j - BACK), j)
        over = np.maximum(np.maximum(q[i] + size[i] - q[j], t[i] + size[i] - t[j]), 0)
        cost = np.where(shift[i] == shift[j], 0, OPEN + np.log2(1.0 + np.abs(shift[i] - shift[j])))
        between = np.maximum(np.minimum(q[j] - q[i] - size[i], t[j] - t[i] - size[i]), 0)
        gain = np.where((q[i] < q[j]) & (t[i] < t[j]) & (over < size[j]), score[i] + size[j] - over - cost - 0.1 * between, -1.0)
        if len(gain) and gain.max() > score[j]:
            before[j] = i[gain.argmax()]
            score[j] = gain.max()
        end[j] = score[j]
    j, out = int(end.argmax()), []
    while j >= 0:
        out.append(j)
        j = int(before[j])
    return out[::-1]


def joined(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Blocks that touch on both sequences as one."""
    out: list[tuple[int, int, int]] = []
    for q, t, n in blocks:
        if out and out[-1][0] + out[-1][2] == q and out[-1][1] + out[-1][2] == t:
            out[-1] = (*out[-1][:2], out[-1][2] + n)
        elif n:
            out.append((q, t, n))
    return out


def aligned(q: np.ndarray, t: np.ndarray, anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Blocks of the alignment along a chain of anchors (q, t, size): filled in between, and extended at both ends."""
    blocks: list[tuple[int, int, int]] = []
    q0, t0, _ = anchors[0]
    reach = t0 - min(t0, q0 + BAND)
    lead = banded(q[:q0][::-1], t[reach:t0][::-1], -BAND, BAND, False)[1]
    blocks += [(q0 - a - n, t0 - b - n, n) for a, b, n in lead[::-1]]
    for a, b, n in anchors:
        if blocks and (a, b) != (q0, t0):
            qe, te = blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]
            cut = max(qe - a, te - b, 0)
            a, b, n = a + cut, b + cut, n - cut
            blocks += [(qe + x, te + y, k) for x, y, k in filled(q[qe:a], t[te:b])]
        blocks.append((a, b, n))
    qe, te = blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]
    tail = banded(q[qe:], t[te : te + len(q) - qe + BAND], -BAND, BAND, False)[1]
    return joined(blocks + [(qe + a, te + b, n) for a, b, n in tail])


def alignment_score(q: np.ndarray, t: np.ndarray, blocks: list[tuple[int, int, int]]) -> tuple[int, int, int, int, int, int, int]:
    """Score, matches, mismatches, and number and bases of inserts on the query and on the target."""
    same = sum(int((q[a : a + n] == t[b : b + n]).sum()) for a, b, n in blocks)
    other = sum(n for *_, n in blocks) - same
    gaps = [(a2 - a - n, b2 - b - n) for (a, b, n), (a2, b2, _) in zip(blocks, blocks[1:], strict=False)]
    on_q, on_t = [x for x, _ in gaps if x], [y for _, y in gaps if y]
    cost = sum(OPEN + EXTEND * x if x <= 2 * BAND else OPEN + 2 * BAND * EXTEND for x in (*on_q, *on_t))
    return MATCH * same + MISMATCH * other - cost, same, other, len(on_q), sum(on_q), len(on_t), sum(on_t)


def found_hits(q: np.ndarray, t: np.ndarray, runs: np.ndarray, least: int) -> Iterator[list[tuple[int, int, int]]]:
    """Alignments of one place, best chain first; each takes the runs that lie within it on the contig."""
    runs = runs[np.lexsort((runs[:, 0], runs[:, 1]))]
    while len(runs):
        chain = chained(*runs.T)
        if runs[chain, 2].sum() < least:
            return
        blocks = aligned(q, t, [tuple(map(int, runs[i])) for i in chain])
        yield blocks
        first, last = blocks[0][1], blocks[-1][1] + blocks[-1][2]
        keep = (runs[:, 1] + runs[:, 2] <= first) | (runs[:, 1] >= last)
        keep[chain] = False
        runs = runs[keep]


def _met(few: DataFrame, many: DataFrame) -> DataFrame:
    """Both sides' places of every k-mer. The rows of a very frequent one are dealt over several keys.

    Which are so frequent is told by a sketch of the most frequent ones, of bounded size, in one pass without a shuffle.
    """
    top = many.agg(F.expr("approx_top_k(kmer, 1000, 10000)").alias("top")).select(F.inline("top")).where(F.col("count") > FREQUENT)
    hot = top.select(F.col("item").alias("kmer"), F.ceil(F.col("count") / FREQUENT).cast("int").alias("parts"))  # 1000 rows at most
    dealt = many.join(F.broadcast(hot), "kmer", "left").withColumn("part", F.pmod(F.xxhash64("contig", "t"), F.coalesce("parts", F.lit(1)))).drop("parts")
    copied = few.join(F.broadcast(hot), "kmer", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1))).drop("parts")
    return copied.join(dealt, ["kmer", "part"])


def _places(targets: DataFrame, contigs: DataFrame, k: int, step: int, max_gap: int) -> DataFrame:
    """(target, strand, contig, first, last, runs): runs of seeds on one diagonal, gathered where no gap on the contig exceeds ``max_gap``."""
    both = targets.select("target", F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.col("sequence")), F.struct(F.lit("-").alias("strand"), seq.reverse_complement(F.col("sequence")).alias("sequence")))).alias("x")).select("target", "x.strand", "x.sequence")
    own = kmers(both, ["target", "strand"], k).select("target", "strand", (F.col("pos") - 1).alias("q"), "kmer")
    seeds = _met(own, kmers_among(contigs, ["contig"], k, both, step).select("contig", (F.col("pos") - 1).alias("t"), "kmer")).select("target", "strand", "contig", "q", "t")
    key = ["target", "strand", "contig"]
    dealt = seeds.repartition(*key).withColumn("diagonal", F.col("t") - F.col("q"))  # what follows keeps these keys together
    along = Window.partitionBy(*key, "diagonal").orderBy("t")
    begins = F.coalesce(F.col("t") - F.lag("t").over(along) > step, F.lit(True))
    numbered = dealt.withColumn("b", begins.cast("int")).withColumn("run", F.sum("b").over(along))
    runs = numbered.groupBy(*key, "diagonal", "run").agg(F.min("q").alias("q"), F.min("t").alias("t"), (F.max("t") - F.min("t") + k).alias("size"))
    by_place = Window.partitionBy(*key).orderBy("t", "q")
    reached = F.max(F.col("t") + F.col("size")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    islands = runs.withColumn("b", F.coalesce(F.col("t") - reached > max_gap, F.lit(True)).cast("int")).withColumn("island", F.sum("b").over(by_place))
    run = F.struct(*[F.col(c).cast("long").alias(c) for c in ("q", "t", "size")])
    return islands.groupBy(*key, "island").agg(F.min("t").alias("first"), F.max(F.col("t") + F.col("size")).alias("last"), F.collect_list(run).alias("runs"), F.sum("size").alias("seeded"))


PSL = "matches long, mismatches long, rep_matches long, n_count long, q_num_insert long, q_base_insert long, t_num_insert long, t_base_insert long, strand string, q_name string, q_size long, q_start long, q_end long, t_name string, t_size long, t_start long, t_end long, block_count long, block_sizes array<long>, q_starts array<long>, t_starts array<long>, score long"


def gapped_hits(targets: DataFrame, contigs: DataFrame, k: int = 11, step: int = 5, max_gap: int = 5000, min_seeded: int = 22, min_score: int = 30, min_identity: float = 0.0) -> DataFrame:
    """PSL rows of targets (``target``, ``sequence``) on contigs (``contig``, ``sequence``), either strand, with gaps.

    Every k-mer of a target meets every ``step``-th of a contig, so an exact match of k + step - 1 letters is always found.
    Seeds on one diagonal become runs, runs with gaps of at most ``max_gap`` on the contig one place, and only the place's
    stretch of the contig goes on with it. There runs are chained, filled in and extended; what is left of the runs
    outside a hit may give further hits. Rows are aligned each on its own, in Arrow batches. Contigs of equal sequences
    are searched once and share the hits.

    Coordinates follow the PSL format: 0-based, half open; on the minus strand ``q_starts`` count from the target's other
    end, while ``q_start`` and ``q_end`` don't. ``score``: matches less mismatches less affine gaps. Hits under ``min_score``
    or ``min_identity`` (by the milli-bad rule) go. Null and short sequences have no hits; names should be unique.
    """
    targets = targets.where("sequence is not null").select("target", F.upper("sequence").alias("sequence"))
    keyed = contigs.where("sequence is not null").select("contig", F.upper("sequence").alias("sequence")).withColumn("key", F.sha2("sequence", 256))
    lead = keyed.groupBy("key").agg(F.min("contig").alias("lead"))
    whole = keyed.join(lead, "key").where("contig = lead").select("contig", "sequence")
    places = _places(targets, whole, k, step, max_gap).where(F.col("seeded") >= min_seeded)
    sized = targets.withColumn("q_size", F.length("sequence")).withColumnRenamed("sequence", "q_text")
    near = places.join(sized, "target").join(whole, "contig")
    margin = F.col("q_size") + BAND
    start = F.greatest(F.lit(0), F.col("first") - margin)
    rows = near.select("target", "strand", F.col("contig").cast("string").alias("contig"), F.when(F.col("strand") == "-", seq.reverse_complement(F.col("q_text"))).otherwise(F.col("q_text")).alias("q"), start.cast("long").alias("start"), F.substring(F.col("sequence"), start.cast("int") + 1, (F.col("last") + margin - start).cast("int")).alias("t"), F.length("sequence").cast("long").alias("t_size"), "runs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PSL.split(", ")]
        for batch in batches:
            out = []
            for target, strand, contig, q, start, t, t_size, runs in zip(*(batch.column(c).to_pylist() for c in ("target", "strand", "contig", "q", "start", "t", "t_size", "runs")), strict=True):
                a, b = np.frombuffer(q.encode("ascii", "replace"), np.uint8), np.frombuffer(t.encode("ascii", "replace"), np.uint8)
                own = np.array([(r["q"], r["t"] - start, r["size"]) for r in runs])
                for blocks in found_hits(a, b, own, min_seeded):
                    score, same, other, qn, qb, tn, tb = alignment_score(a, b, blocks)
                    if score < min_score:
                        continue
                    first, last = blocks[0][0], blocks[-1][0] + blocks[-1][2]
                    if strand == "-":
                        first, last = len(a) - last, len(a) - first
                    out.append((same, other, 0, 0, qn, qb, tn, tb, strand, target, len(a), first, last, contig, t_size, start + blocks[0][1], start + blocks[-1][1] + blocks[-1][2], len(blocks), [x[2] for x in blocks], [x[0] for x in blocks], [start + x[1] for x in blocks], score))
            if out:
                kinds = [pa.string() if n in ("strand", "q_name", "t_name") else pa.list_(pa.int64()) if n in ("block_sizes", "q_starts", "t_starts") else pa.int64() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names)

    hits = rows.mapInArrow(align, PSL)
    c = F.col
    hits = hits.withColumn("identity", hit_identity(c("matches"), c("mismatches"), c("q_num_insert"), c("q_end") - c("q_start"), c("t_end") - c("t_start")))
    copies = keyed.join(lead, "key").select(F.col("lead").cast("string").alias("t_name"), F.col("contig").cast("string").alias("contig"))
    order = [f.split()[0] for f in PSL.split(", ")] + ["identity"]
    return hits.where(F.col("identity") >= min_identity).join(copies, "t_name").drop("t_name").withColumnRenamed("contig", "t_name").select(*order)
