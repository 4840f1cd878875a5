"""A sink that writes lines to named files, one file a locus, with a commit that moves finished files into place."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .writers import fasta_lines


def _store(path: str):
    """The file system that holds ``path``, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and "://" not in path:
        path = path[5:]
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{posixpath.abspath(path)}")


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[str]


class _Writer(DataSourceArrowWriter):
    """Each attempt of a task writes into a folder of its own; the commit moves the files of the attempts that count."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.staging = path.rstrip("/"), overwrite, f"{path.rstrip('/')}/.staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, base = _store(self.staging)
        folder, files, name, out = f"{base}/{uuid.uuid4().hex}", [], None, None
        try:
            for batch in batches:
                for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist(), strict=True):
                    if file != name:
                        if out:
                            out.close()
                        if not file or file in files or "/" in file or file.startswith("."):
                            raise ValueError(f"{file!r} is no file's name, or its lines aren't together")
                        store.create_dir(folder, recursive=True)
                        out, name = store.open_output_stream(f"{folder}/{file}"), file
                        files.append(file)
                    out.write((line or "").encode() + b"\n")
        finally:
            if out:
                out.close()
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = _store(self.path)
        done = [m for m in messages if m]
        names = [f for m in done for f in m.files]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("a file's lines came from several tasks")
        from pyarrow import fs

        store.create_dir(base, recursive=True)
        for m in done:
            for f in m.files:
                store.move(f"{m.folder}/{f}", f"{base}/{f}")
        if self.overwrite:  # last, so that a crash leaves too many files rather than too few
            kept = set(names)
            for x in store.get_file_info(fs.FileSelector(base)):
                if x.is_file and x.base_name not in kept:
                    store.delete_file(x.path)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, base = _store(self.staging)
        if store.get_file_info(base).type == fs.FileType.Directory:
            store.delete_dir(base)


class LineFiles(DataSource):
    """``line_files``: rows (file, line), a file's lines together and in order, to files of those names in a folder."""

    @classmethod
    def name(cls) -> str:
        return "line_files"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def write_files(lines: DataFrame, path: str, order: list[str], overwrite: bool = True) -> None:
    """``lines`` (file, line, and columns of ``order``) to one named file each; names that end with .gz are compressed.

    Rows are dealt by file and sorted, so a task streams its files one after the other. With ``overwrite`` files of other names in the
    folder go. A retried task leaves no second file: only the attempt that Spark commits is moved into place.
    """
    lines.sparkSession.dataSource.register(LineFiles)
    dealt = lines.repartition("file").sortWithinPartitions("file", *order).select("file", "line")
    dealt.write.format("line_files").mode("overwrite" if overwrite else "append").save(path)


def fasta_files(rows: DataFrame, suffix: str = ".fasta", width: int = 80) -> DataFrame:
    """(file, name, line) of FASTA files, one a locus, from rows (locus, name, sequence, maybe description)."""
    description = F.col("description") if "description" in rows.columns else None
    return rows.select(F.concat("locus", F.lit(suffix)).alias("file"), "name", fasta_lines(F.col("name"), F.col("sequence"), description, width).alias("line"))


def nexus_files(rows: DataFrame, kind: str = "NT", width: int = 0, suffix: str = ".nex") -> DataFrame:
    """(file, ord, block, name, line) of NEXUS data blocks, one file a locus; with ``width`` interleaved, so many sites a block.

    Names are padded to a locus's longest; each block of an interleaved matrix ends with an empty line. Rows are (locus, name, sequence).
    """
    c = F.col
    size = rows.groupBy("locus").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("sequence")).alias("w"), F.max(F.length("name")).alias("p"))
    file = F.concat("locus", F.lit(suffix)).alias("file")
    of = lambda ord_, block, line: F.struct(F.lit(ord_).alias("ord"), block.cast("int").alias("block"), line.alias("line"))
    style = ("INTERLEAVE " if width else "") + "DATATYPE=" + ("DNA" if kind == "NT" else "PROTEIN")
    head = [F.lit("#NEXUS"), F.lit("BEGIN DATA;"), F.format_string("DIMENSIONS NTAX=%d NCHAR=%d;", c("n"), c("w")), F.lit(f"FORMAT {style} GAP=- MISSING=?;"), F.lit("MATRIX")]
    edge = F.array(*[of(i, F.lit(0), x) for i, x in enumerate(head)], of(9, F.lit(0), F.lit(";")), of(10, F.lit(0), F.lit("END;")))
    rest = F.transform(F.sequence(F.lit(1), F.ceil(c("w") / width)), lambda b: of(5, b - 1, F.lit(""))) if width else F.array().cast("array<struct<ord:int,block:int,line:string>>")
    around = size.select(file, F.inline(F.concat(edge, rest))).select("file", "ord", "block", F.lit(None).cast("string").alias("name"), "line")
    cuts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("sequence") / width) - 1, F.lit(0))), lambda b: F.struct(b.cast("int").alias("block"), F.substring(c("sequence"), (b * width + 1).cast("int"), F.lit(width)).alias("s"))) if width else F.array(F.struct(F.lit(0).alias("block"), c("sequence").alias("s")))
    body = rows.join(size.select("locus", "p"), "locus").select(file, c("name"), "p", F.inline(cuts)).select("file", F.lit(5).alias("ord"), "block", "name", F.concat(F.rpad("name", c("p"), F.lit(" ")), F.lit(" "), "s").alias("line"))
    return around.union(body)


def write_nexus_files(rows: DataFrame, path: str, kind: str = "NT", width: int = 0) -> None:
    """One NEXUS file a locus; see ``nexus_files``."""
    write_files(nexus_files(rows, kind, width), path, ["ord", "block", F.col("name").asc_nulls_last()])


def write_fasta_files(rows: DataFrame, path: str, suffix: str = ".fasta", width: int = 80) -> None:
    """One FASTA file a locus, by name."""
    write_files(fasta_files(rows, suffix, width), path, ["name"])
