"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset (tests) a folder under the
    warehouse is used, which one machine shares with itself.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage for good."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """An operator's rounds in the shared folder; a table replaces the former one of its name, whose files go.

    The former is removed only after the new one has been written whole, so a lost executor's work can
    always be done again from what is there.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if old := self.paths.pop(name, None):
                at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HELD: dict = {}


def held(key, make):
    """What ``make`` gives, made once a worker process and kept for its later tasks."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Drop what a worker holds of another operator (tokenizers and their caches) before a task that doesn't use it."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def crc_mod(column: str, modulus: int):
    """crc32 of the value as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """(first row, texts) in pieces of about ``limit`` bytes, nulls as empty texts."""
    values, start, held, size = batch.column(column), 0, [], 0
    for i, value in enumerate(values):
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= limit:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes whose words are hashed at a time, which bounds what a worker holds for it to some 50 MB.
_BLOCK = 1 << 19


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes with all bits stirred."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    """Hashes of words, looked up or made; of short words a bounded number stays."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 32 and len(self) < 200_000:
            self[word] = h
        return h


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of lower-cased UTF-8 text, and the byte at which each begins.

    Words are what is left between ASCII white space. Each is hashed by its own bytes with a cryptographic hash, so
    unlike words that hash alike can't be made up; a worker keeps the hashes of frequent words.
    """
    whole = np.frombuffer(data, np.uint8)
    known = held(_Words, _Words)
    hashes, places, first = [], [], 0
    while first < len(whole):
        last = min(len(whole), first + _BLOCK)
        while last < len(whole) and not _IS_SPACE[whole[last]]:  # a word isn't cut
            last += 1
        words = data[first:last].split()
        hashes.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        space = np.ones(last - first + 1, bool)
        space[1:] = _IS_SPACE[whole[first:last]]
        places.append(np.flatnonzero(~space[1:] & space[:-1]) + first)
        first = last
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)
