"""Best-fit packing by minimum bin slack: bins are filled by subset sums over the lengths that are left."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised, read_table, text_chunks
from .tokenize import ByteBpe, loaded, tokenizer_path


#: Tokens of a bin that may stay unused before shorter lengths are looked at; each is tried.
SLACKS = (0, 2, 8, 32)


def _filled(counts: dict[int, int], size: int, slack: int) -> list[tuple[int, list[tuple[int, int]]]]:
    left = {length: n for length, n in counts.items() if n > 0}
    order, out = sorted(left, reverse=True), []
    while order:
        top = order[0]
        room = size - top
        left[top] -= 1
        reach, seen, mask = 1, [], (1 << room + 1) - 1
        for length in order:
            if length > room or not left[length]:
                continue
            seen.append((length, reach))
            more, step = min(left[length], room // length), 1
            while more:  # so many copies at most, in powers of two
                step = min(step, more)
                reach |= reach << length * step & mask
                more -= step
                step *= 2
            if reach >> max(0, room - slack):
                break
        left[top] += 1
        goal, chosen = reach.bit_length() - 1, {top: 1}
        for length, before in reversed(seen):
            while not before >> goal & 1:
                goal -= length
                chosen[length] = chosen.get(length, 0) + 1
        repeats = min(left[length] // k for length, k in chosen.items())
        for length, k in chosen.items():
            left[length] -= repeats * k
        order = [length for length in order if left[length]]
        out.append((repeats, sorted(chosen.items(), reverse=True)))
    return out


def fullest_bins(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, how many of it in a bin)]), which use up every item of ``counts``.

    Each bin takes the longest item that is left and the fullest feasible combination of others beside it: a bitset
    holds the sums that lengths, long to short, can reach, and is read backwards from the highest. Lengths are
    added until one sum leaves no more than ``slack`` unused; a little slack spares the short items, which fill what
    long ones can't. Of several such bounds, 0 among them, the way with the fewest bins is returned. A combination is
    repeated as long as the counts allow it, so the work depends on the lengths, not on the items.
    """
    if any(not 0 < length <= size for length, n in counts.items() if n > 0):
        raise ValueError("lengths must lie between 1 and the bin size")
    return min((_filled(counts, size, way) for way in SLACKS), key=lambda bins: sum(repeats for repeats, _ in bins))


def _placing(bins: list[tuple[int, list[tuple[int, int]]]], counts: dict[int, int]) -> np.ndarray:
    """Rows (length, first rank, copies in a bin, first bin, offset of the first copy), by length and rank."""
    rows, taken, first = [], dict.fromkeys(counts, 0), 0
    for repeats, chosen in bins:
        offset = 0
        for length, k in chosen:
            rows.append((length, taken[length], k, first, offset))
            taken[length] += repeats * k
            offset += length * k
        first += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _cut(docs: DataFrame, path: str, end: bytes, size: int, with_tokens: bool) -> DataFrame:
    """Pieces with the task they come from and their place among its pieces of equal length."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "tokens"][: 7 + with_tokens]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, met = loaded(ByteBpe, path), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, "text"):
                rows, held, tokens = [], [], []
                for i, text in enumerate(texts):
                    data = bpe.encode(text) + end
                    total, at = len(data) // 4, 0
                    for piece in range(-(-total // size)):
                        length = (total % size or size) if piece == 0 else size
                        own = data[4 * at : 4 * (at + length)]
                        rows.append(first + i)
                        held.append((piece, at, length, zlib.crc32(own), part, met[length]))
                        if with_tokens:
                            tokens.append(own)
                        met[length] += 1
                        at += length
                columns = [pa.array(x, pa.int32() if k == 0 else pa.int64()) for k, x in enumerate(zip(*held, strict=True))]
                more = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(t) // 4 for t in tokens)]), pa.int32()), pa.array(np.frombuffer(b"".join(tokens), np.int32)))] if with_tokens else []
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *columns, *more], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part long, nth long" + ", tokens array<int>" * with_tokens
    return docs.mapInArrow(pieces, schema)


def pack_minimum_slack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, max_tokens: int = 2048, with_tokens: bool = True
) -> DataFrame:
    """Pieces of every document with the sequence that holds them and their place in it.

    A document's ids, ended by ``end_id``, stay whole up to ``max_tokens``; longer ones are cut into pieces of
    ``max_tokens``, the first of which may be shorter. Pieces are numbered among those of their length: by their
    place in the task that made them, plus a running sum of the tasks' counts. The counts of the (at most
    ``max_tokens``) lengths go to the driver, which fills bins by minimum slack; the bins, of which there are a few a
    length, come back to the tasks as a table of ranks. So what is broadcast depends on ``max_tokens`` alone, and a
    length that very many pieces share is dealt over the tasks that made them. Pieces are written once to the shared
    folder, as both the counting and the placing read them.

    Null and empty texts are one piece that holds ``end_id`` alone. Repeated rows are packed each on its own. Null
    ids stay null. Other columns of ``docs`` are not read, so clashing names can't matter. An empty table gives no rows.

    :param tokenizer: path of a byte-level BPE file for ``tokenizers``
    :param with_tokens: also return the piece's ids as ``tokens``
    """
    if max_tokens < 1:
        raise ValueError("max_tokens must be positive")
    spark, path = docs.sparkSession, tokenizer or tokenizer_path("byte_bpe_50k.json")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut = materialised(_cut(source, path, int(end_id).to_bytes(4, "little"), max_tokens, with_tokens), "pieces")
    cells = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(_placing(fullest_bins(counts, max_tokens), counts))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = cells.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(based, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *["tokens"] * with_tokens]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        keys = np.rec.fromarrays([rows[:, 0], rows[:, 1]], names="length,rank")
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, np.rec.fromarrays([length, rank], names="length,rank"), "right") - 1
            _, low, copies, first, offset = rows[at].T
            sequence, nth = first + (rank - low) // copies, (rank - low) % copies
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in out), pa.array(sequence), pa.array(offset + nth * length)], [*out, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*out).schema)
    return ranked.select(*out, "rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def op12_slack(spark, sf_dir: str) -> DataFrame:
    return pack_minimum_slack(read_table(spark, sf_dir, "documents"), with_tokens=False)
