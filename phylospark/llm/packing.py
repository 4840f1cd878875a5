"""Packing by power-of-two decomposition: equal-length pieces, no sequence across documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks
from .tokenize import WordBpe, loaded, tokenizer_path


def binary_lengths(total: int, longest: int) -> list[int]:
    """Full pieces of ``longest``, then the binary digits of the rest, large to small."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_power_of_two(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 2, max_tokens: int = 4096, with_tokens: bool = True
) -> DataFrame:
    """Pieces of every document, each one sequence of a power-of-two length, grouped by ``bucket``.

    A document's ids, ended by ``end_id``, are cut into full pieces of ``max_tokens`` (a power of two)
    and the binary digits of the remainder. Every piece is a sequence of its own: nothing is padded and
    no sequence crosses documents. ``bucket`` is the sequence length, so a loader draws batches from
    one bucket at a time, or the result is written with ``partitionBy("bucket")``.

    Narrow: one scan and no shuffle. Sequence ids come from the partition and the row's place in it, as
    scans of files are split alike on each attempt.

    Null and empty texts are one piece that holds ``end_id`` alone. Repeated rows are packed each on its
    own. Null ids stay null. Other columns of ``docs`` are not read, so clashing names can't matter. An
    empty table gives no rows.

    :param tokenizer: path of a word-end BPE file for ``tokenizers``
    :param with_tokens: also return the piece's ids as ``tokens``
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "tokens"][: 5 + with_tokens]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(WordBpe, path)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, "text"):
                rows, start, length, crc, whole, tokens = [], [], [], [], [], []
                for i, data in enumerate(bpe.encode(texts)):
                    data += end
                    total, at = len(data) // 4, 0
                    for size in binary_lengths(total, max_tokens):
                        part = data[4 * at : 4 * (at + size)]
                        rows.append(first + i)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(part))
                        whole.append(total)
                        if with_tokens:
                            tokens.append(part)
                        at += size
                long = [pa.array(x, pa.int64()) for x in (start, length, crc, whole)]
                more = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), pa.array(np.frombuffer(b"".join(tokens), np.int32)))] if with_tokens else []
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *long, *more], names)

    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", tokens array<int>" * with_tokens
    out = source.mapInArrow(pieces, schema)
    return out.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.col("length")})


def op4_packing(spark, sf_dir: str) -> DataFrame:
    from .common import read_table

    packed = pack_power_of_two(read_table(spark, sf_dir, "documents"), with_tokens=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")
