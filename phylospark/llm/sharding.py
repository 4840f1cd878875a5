"""Hilbert-curve shards: runs along a space-filling curve through metadata, for file pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table

#: Rows of one curve cell are dealt over sub-cells so that no rank is taken over more than about a
#: 1/SLOTS part of the table; the number of (cell, sub-cell) groups is at most 2**(3 * bits) + SLOTS.
SLOTS = 2048


def hilbert_index(frame: DataFrame, dims: list[str], bits: int, out: str) -> DataFrame:
    """Add the position on the Hilbert curve of the cell with the integer coordinates ``dims``.

    Skilling's transformation, one projection a step, so that expressions stay small.
    """
    x = [f"__{out}_{i}" for i in range(len(dims))]
    frame = frame.withColumns({c: F.col(d).cast("long") for c, d in zip(x, dims, strict=True)})
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, p = 1 << level, (1 << level) - 1
        for i in range(n):
            is_set = F.col(x[i]).bitwiseAND(F.lit(q)) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(x[i])).bitwiseAND(F.lit(p))
            step = {x[0]: F.when(is_set, F.col(x[0]).bitwiseXOR(F.lit(p))).otherwise(F.col(x[0]).bitwiseXOR(swap))}
            if i:
                step[x[i]] = F.when(is_set, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swap))
            frame = frame.withColumns(step)
    for i in range(1, n):
        frame = frame.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    turn: Column = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << level)) != 0, F.lit((1 << level) - 1)).otherwise(F.lit(0)).cast("long"))
    frame = frame.withColumn(f"__{out}_t", turn)
    frame = frame.withColumns({c: F.col(c).bitwiseXOR(F.col(f"__{out}_t")) for c in x})
    index: Column = F.lit(0).cast("long")
    for level in range(bits):
        for i, c in enumerate(x):
            index = index + F.shiftleft(F.shiftright(F.col(c), level).bitwiseAND(F.lit(1)), level * n + n - 1 - i)
    return frame.withColumn(out, index).drop(*x, f"__{out}_t")


def shard_hilbert(docs: DataFrame, shards: int = 8, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Put every row into one of ``shards`` runs of the Hilbert curve over (language, source, size).

    Language and source are quantised by a hash of their value to ``2**bits`` codes, size by its binary
    logarithm; rows are sorted by curve index and cut into runs whose counts differ by at most one, so a
    file of a run covers few values of each dimension at once and min/max statistics prune it.

    The global rank needs no global sort: counts of cells and of their sub-cells (a bounded table) are
    summed up along the curve, and ranks are taken inside a sub-cell. Cells that hold many rows, such as
    a source with a third of the table, are dealt over as many sub-cells as their share asks for.
    Only ids, sizes and checksums are shuffled, never texts.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, curve (curve index), shard and slot (from 0
    without gaps inside a shard). Null texts count as empty; null languages, sources and ids are values
    of their own. Repeated rows each get a slot. Other columns aren't read. An empty table gives no rows.
    """
    top = (1 << bits) - 1
    code = lambda c: F.pmod(F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("\0")).cast("binary")), F.lit(top + 1))
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    cells = docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), code(lang_col).alias("q0"), code(source_col).alias("q1"))
    cells = cells.withColumn("q2", F.least(F.lit(top), F.floor(F.log2(F.col("size")) * ((top + 1) / 20.0))).cast("long"))
    key = ["q0", "q1", "q2"]
    counts = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("total"))
    widths = counts.select(*key, F.ceil(F.col("n") * SLOTS / whole.scalar()).alias("width"))
    dealt = cells.join(F.broadcast(widths), key).withColumn("sub", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.col("width")))
    groups = hilbert_index(dealt.groupBy(*key, "sub").agg(F.count(F.lit(1)).alias("n")), key, bits, "curve")
    along = Window.orderBy("curve", "sub")
    placed = groups.withColumn("before", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    placed = placed.drop("n").withColumn("total", whole.scalar())
    inside = Window.partitionBy(*key, "sub").orderBy("doc_id", "text_crc32", "size")
    ranked = dealt.withColumn("within", F.row_number().over(inside) - 1).join(F.broadcast(placed), [*key, "sub"])
    ranked = ranked.withColumns({"rank": F.col("before") + F.col("within"), "each": F.expr(f"total div {shards}"), "more": F.col("total") % shards})
    edge = (F.col("each") + 1) * F.col("more")
    ranked = ranked.withColumn("shard", F.when(F.col("rank") < edge, F.expr("rank div (each + 1)")).otherwise(F.expr("more + (rank - (each + 1) * more) div greatest(each, 1)")).cast("int"))
    start = F.col("shard") * F.col("each") + F.least(F.col("shard").cast("long"), F.col("more"))
    return ranked.select("doc_id", "size", "text_crc32", "curve", "shard", (F.col("rank") - start).cast("long").alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_hilbert(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
