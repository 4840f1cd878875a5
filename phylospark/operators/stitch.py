"""Partial hits of one copy as one sequence: pieces in query order, cut where they overlap, Ns where nothing was found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phylospark.functions import seq
from phylospark.operators.hits import FLANK, extract_blocks, weighted_score

#: Least overlap of two contigs' flanks, the identity that it needs, and what stands between contigs that don't overlap.
LEAST_OVERLAP, OVERLAP_IDENTITY, SEPARATOR = 21, 0.9667, "n" * 10


def _shares() -> np.ndarray:
    """Share of bases that two letters have in common, by their codes."""
    table = np.zeros((128, 128))
    for pair, value in seq.pair_identity("NT").items():
        for a, b in (pair, pair[::-1]):
            for x in (a, a.lower()):
                for y in (b, b.lower()):
                    table[ord(x), ord(y)] = value
    return table


_SHARE = _shares()


def longest_overlap(trail: str, lead: str) -> int:
    """The longest end of ``trail`` that ``lead`` begins with at nearly full identity of their ambiguity sets; 0 if it's under the least."""
    a, b = (np.frombuffer(s.encode("ascii", "replace"), np.uint8) & 127 for s in (trail, lead))
    n = min(len(a), len(b))
    if n <= LEAST_OVERLAP:
        return 0
    for size in range(n, LEAST_OVERLAP - 1, -1):
        if _SHARE[a[len(a) - size :], b[:size]].sum() >= OVERLAP_IDENTITY * size - 1e-9:
            return size
    return 0


def overlap_length(trail: Column, lead: Column) -> Column:
    """``longest_overlap`` of two columns; null is empty."""

    @F.arrow_udf(returnType="int")
    def overlaps(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([longest_overlap(x or "", y or "") for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int32())

    return overlaps(trail, lead)


def flanks_joined(left: str, left_depth: float, right: str, right_depth: float, gap: int) -> str:
    """Two flanked pieces (matches in upper case) as one scaffold.

    Flanks that overlap meet there, and the shallower contig loses the overlap; else Ns stand for what the gap on the query
    leaves beside both flanks, a separator at least. As the documented rule has it, the right piece's flank reaches to its last
    matched base.
    """
    upper = [i for i, c in enumerate(left) if c.isupper()]
    trail = left[upper[-1] + 1 :] if upper else ""
    upper = [i for i, c in enumerate(right) if c.isupper()]
    lead = right[: upper[-1]] if upper else ""
    size = longest_overlap(trail, lead)
    if not size:
        n = gap - len(trail) - len(lead)
        return left + ("n" * n if n > 0 else SEPARATOR) + right
    return left + right[size:] if left_depth >= right_depth else left[:-size] + right


def stitched_parts(parts: list[dict]) -> dict:
    """One sequence of a path's parts, which come by their place on the query; see ``stitch_paths``."""
    first = parts[0]
    gene, flanked, ends = first["gene"], first["flanked"], [[p["q_start"], p["q_end"]] for p in parts]
    for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)):
        over = a["q_end"] - b["q_start"]
        if over <= 0:
            flanked = flanks_joined(flanked, a["depth"], b["flanked"], b["depth"], -over)
            gene += "n" * -over + b["gene"]
        elif a["identity"] >= b["identity"]:
            flanked, gene = flanked + b["flanked"][over:], gene + b["gene"][over:]
            ends[i + 1][0] += over
        else:
            flanked, gene = flanked[:-over] + b["flanked"], gene[:-over] + b["gene"]
            ends[i][1] -= over
    matched = ends[-1][1] - ends[0][0] - (gene.count("n") if len(parts) > 1 else 0)
    return {"seq_gene": gene, "seq_flanked": flanked, "ref_coords": ";".join(f"{s + 1}-{e}" for s, e in ends), "match_len": matched, "gapped": "n" in gene}


def stitch_paths(hits: DataFrame, paths: DataFrame, contigs: DataFrame, keys: list[str], contig_keys: tuple[str, ...] = ("contig",), flank: int = FLANK) -> DataFrame:
    """Every path of partial hits as one hit with its sequences.

    ``hits`` hold hit_id, q_start, q_end, q_size, matches, mismatches, identity, coverage, strand, contig, depth and ``blocks`` (array of
    s, e on the contig); ``paths`` name each hit's path. A hit's matched blocks give its ``seq_gene``, with introns and
    flanks in lower case its ``seq_flanked``, both turned round on the minus strand. Along the query a gap between parts is filled
    with n; of an overlap the part of lower identity loses its bases. Coverage, identity (the parts' mean) and scores are
    those of the whole; a path of one hit keeps its own coverage and identity. Only contigs' stretches around a hit are
    shuffled on, and a path's parts, which hardly overlap on the query, are one row. Hits on contigs that aren't there go.
    """
    c = F.col
    own = hits.join(paths.select(*keys, "hit_id", "path"), [*keys, "hit_id"]).join(contigs.select(*contig_keys, c("sequence").alias("__s")), list(contig_keys))
    turned = lambda x: F.when(c("strand") == "-", seq.reverse_complement(x)).otherwise(x)
    gene = F.array_join(F.transform("blocks", lambda b: F.upper(F.substring(c("__s"), (b.s + 1).cast("int"), (b.e - b.s).cast("int")))), "")
    part = F.struct("q_start", "q_end", c("hit_id").cast("string").alias("hit_id"), "identity", c("depth").cast("double").alias("depth"), c("contig").cast("string").alias("contig"), "strand", "matches", "mismatches", "coverage", turned(gene).alias("gene"), turned(extract_blocks(c("__s"), c("blocks"), flank)).alias("flanked"))
    rows = own.groupBy(*keys, "path").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("q_size").alias("q_size"))
    of = lambda f: F.array_join(F.transform("parts", lambda x: x[f]), ",")
    total = lambda f: F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x[f].cast("long"))
    whole = rows.select(
        *keys, "path", F.size("parts").alias("contigs"), of("hit_id").alias("hit_ids"), of("contig").alias("hit_contigs"), of("strand").alias("strand"), total("matches").alias("matches"), total("mismatches").alias("mismatches"), "q_size",
        F.aggregate("parts", F.lit(0.0), lambda a, x: a + x.identity, lambda a: a / F.size("parts")).alias("identity"), F.element_at("parts", 1).coverage.alias("own_coverage"), "parts",
    )
    names = ["seq_gene", "seq_flanked", "ref_coords", "match_len", "gapped"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    kept = [x for x in whole.columns if x != "parts"]

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [stitched_parts(p) for p in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *(pa.array([m[n] for m in made], k) for n, k in zip(names, kinds, strict=True))], [*kept, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema if f.name != "parts") + ", seq_gene string, seq_flanked string, ref_coords string, match_len long, gapped boolean"
    out = whole.mapInArrow(stitch, schema)
    coverage = F.when(c("contigs") > 1, 100.0 * c("match_len") / c("q_size")).otherwise(c("own_coverage"))
    score = F.try_divide((c("matches") - c("mismatches")) * F.when(c("contigs") > 1, c("match_len") / (c("matches") + c("mismatches"))).otherwise(F.lit(1.0)), c("q_size"))
    out = out.withColumn("coverage", coverage).withColumn("score", F.round(score, 6)).withColumn("wscore", F.round(weighted_score(c("identity"), c("coverage"), c("contigs")), 6))
    return out.select(*keys, "path", "contigs", "hit_ids", "hit_contigs", "strand", "ref_coords", "matches", "mismatches", F.round("identity", 4).alias("identity"), F.round("coverage", 4).alias("coverage"), "score", "wscore", "match_len", "gapped", "seq_gene", "seq_flanked")
