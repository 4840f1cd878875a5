"""Sinks: FASTA, matrices, partition texts and tables, written in parallel unless the format is one ordered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phylospark.functions import seq


def fasta_lines(name: Column, sequence: Column, description: Column | None = None, width: int = 0) -> Column:
    head = name if description is None else F.concat_ws(" ", name, F.when(description != "", description))
    return F.concat(F.lit(">"), head, F.lit("\n"), seq.wrap(sequence, width))


def write_fasta(frame: DataFrame, path: str, width: int = 80, sort: bool = False, partition_by: list[str] = (), mode: str = "overwrite", compression: str | None = None) -> None:
    """FASTA part files; with ``partition_by`` one folder a value, with ``sort`` by name inside each part."""
    description = F.col("description") if "description" in frame.columns else None
    out = frame.sortWithinPartitions(*partition_by, "name") if sort else frame
    out = out.select(*partition_by, fasta_lines(F.col("name"), F.col("sequence"), description, width).alias("value"))
    writer = out.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)


def nexus_lines(matrix: DataFrame, kind: str = "NT", missing: str = "?", gap: str = "-") -> DataFrame:
    """(ord, line) of a NEXUS data block, names padded to the longest."""
    size = matrix.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("sequence")).alias("w"), F.max(F.length("name")).alias("p"))
    datatype = "DNA" if kind == "NT" else "PROTEIN"
    head = size.select(F.explode(F.array(*[F.struct(F.lit(i).alias("ord"), c.alias("line")) for i, c in enumerate((F.lit("#NEXUS"), F.lit("BEGIN DATA;"), F.format_string("DIMENSIONS NTAX=%d NCHAR=%d;", F.col("n"), F.col("w")), F.lit(f"FORMAT DATATYPE={datatype} MISSING={missing} GAP={gap};"), F.lit("MATRIX")))])).alias("x")).select("x.ord", F.lit("").alias("name"), "x.line")
    pad = size.select("p").scalar()
    body = matrix.select(F.lit(100).alias("ord"), "name", F.concat(F.rpad("name", pad + 2, " "), "sequence").alias("line"))
    foot = size.select(F.lit(200).alias("ord"), F.lit("").alias("name"), F.lit(";\nEND;").alias("line"))
    return head.union(body).union(foot)


def phylip_lines(matrix: DataFrame) -> DataFrame:
    """(ord, name, line) of a sequential PHYLIP text."""
    size = matrix.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("sequence")).alias("w"), F.max(F.length("name")).alias("p"))
    head = size.select(F.lit(0).alias("ord"), F.lit("").alias("name"), F.format_string("%d %d", F.col("n"), F.col("w")).alias("line"))
    pad = size.select("p").scalar()
    return head.union(matrix.select(F.lit(1).alias("ord"), "name", F.concat(F.rpad("name", pad + 2, " "), "sequence").alias("line")))


def phylip_blocks(matrix: DataFrame, width: int) -> DataFrame:
    """(block, name, line) of an interleaved PHYLIP text: names in the first block only."""
    cuts = F.transform(F.sequence(F.lit(1), F.length("sequence"), F.lit(width)), lambda i: F.substring(F.col("sequence"), i, F.lit(width)))
    rows = matrix.select("name", F.posexplode(cuts).alias("block", "piece"))
    return rows.select("block", "name", F.when(F.col("block") == 0, F.concat_ws("  ", "name", "piece")).otherwise(F.col("piece")).alias("line"))


def partition_lines(parts: DataFrame, style: str = "RAxML", kind: str = "NT") -> DataFrame:
    """(ord, line) of a partition file over rows (locus, start, end, sites)."""
    w = Window.orderBy("start")
    if style == "RAxML":
        return parts.select(F.row_number().over(w).alias("ord"), F.concat(F.lit("DNA, " if kind == "NT" else "AUTO, "), "locus", F.lit(" = "), F.replace("sites", F.lit(" "), F.lit(", "))).alias("line"))
    body = parts.select(F.row_number().over(w).alias("ord"), F.concat(F.lit("  charset "), "locus", F.lit(" = "), "sites", F.lit(";")).alias("line"))
    edge = parts.limit(1).select(F.explode(F.array(F.struct(F.lit(-1).alias("ord"), F.lit("#nexus\nbegin sets;").alias("line")), F.struct(F.lit(1 << 30).alias("ord"), F.lit("end;").alias("line")))).alias("x")).select("x.ord", "x.line")
    return edge.union(body)


def write_ordered_text(lines: DataFrame, path: str, order: list[str]) -> None:
    """One text in order; for matrices that a single program reads as one file."""
    lines.orderBy(*order).select(F.col("line").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_table(frame: DataFrame, path: str, order: list[str] = ()) -> None:
    """Tab-separated text with NA for null, sorted inside parts."""
    out = frame.sortWithinPartitions(*order) if order else frame
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
