"""SentencePiece BPE encoding by a table of prefixes, and decoding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_chunks
from .tokenize import PrefixBpe, loaded, tokenizer_path


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, digest: bool = False) -> DataFrame:
    """Piece ids of every whole text and the text that they decode to.

    Equal to the sentencepiece library's encoding for BPE models with an identity normaliser, a dummy
    prefix, and byte fallback, without begin and end ids. Long texts cost time in proportion to their
    length: each prefix has one last token, found from automaton matches. Narrow: one scan, no shuffle.

    Null and empty texts have no ids and decode to the empty text. Repeated rows are encoded each.
    Other columns of ``docs`` aren't read. An empty table gives no rows.

    :param digest: instead of ``ids`` and ``decoded`` give their SHA-256 (decimal ids joined by commas)
    """
    path = model or tokenizer_path("piece_bpe_32k.model")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(PrefixBpe, path)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, "text"):
                counts, left, right = [], [], []
                for text in texts:
                    joined, decoded = bpe.encode(text)
                    counts.append(joined.count(",") + 1 if joined else 0)
                    if digest:
                        left.append(hashlib.sha256(joined.encode()).hexdigest())
                        right.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        left.append([int(x) for x in joined.split(",")] if joined else [])
                        right.append(decoded)
                kind = pa.string() if digest else pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(counts, pa.int64()), pa.array(left, kind), pa.array(right, pa.string())],
                    ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return source.mapInArrow(encode, f"doc_id {kind}, n_tokens long, {rest}")


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_pieces(read_table(spark, sf_dir, "documents"), digest=True)
