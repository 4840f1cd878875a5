"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary, and the form each goes back to."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialised, mixed, read_table

RUN = re.compile("[a-zÀ-ÿ]+")
#: Distinct words that a task counts before it passes them on.
HELD = 300_000
#: Words of this length or longer share one length class; their lengths are part of the hash.
LAST_CLASS = 64
#: Words that one task probes, as their edits cost far more than their bytes show.
PROBED = 50_000
#: Words a filter segment holds, bits a word, and bits broadcast at a time (64 MB).
SEGMENT, WORD_BITS, MAX_BITS = 1 << 21, 24, 1 << 29
#: Edits hashed at a time, which bounds what a worker holds for it to some 50 MB.
BLOCK = 1 << 20


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int | None = None) -> DataFrame:
    """(word, n): maximal runs of Latin letters (A-Z lower-cased, no other letter) and how often each occurs.

    With ``drop_every`` a run whose crc32 of ``<id>:<run>`` is divisible by it loses the code point at crc32 modulo its
    length, as a typing slip that is the same in all of a document; a run of one letter may become the empty word.
    Tasks count before the shuffle. Null texts hold no words, a null id counts as the empty text.
    """
    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t")).where("t is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column("i"), batch.column("t"), strict=True):
                own = Counter(RUN.findall(text.as_py().encode().lower().decode()))
                if not drop_every:
                    total.update(own)
                else:
                    begun = zlib.crc32(f"{i}:".encode())
                    for word, n in own.items():
                        h = zlib.crc32(word.encode(), begun)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        total[word] += n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        yield out()

    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _letters(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A 64-bit value for each letter at a place; a word's hash is their sum, so an edit changes it by a few terms."""
    return mixed(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + code.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(1))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _whole(codes: np.ndarray) -> np.ndarray:
    """Stirred hashes of words of one length, in blocks of places."""
    n, length = codes.shape
    total, step = np.full(n, length, np.uint64), max(1, BLOCK // n)
    for p in range(0, length, step):
        total += _letters(np.arange(p, min(length, p + step)), codes[:, p : p + step]).sum(1, dtype=np.uint64)
    return mixed(total)


@dataclass
class Shards:
    """Blocked Bloom filters of a vocabulary by word length; a long shard is cut into slices by the hash."""

    slices: np.ndarray  # of each length class
    blocks: np.ndarray  # 64-bit blocks of each slice
    held: dict[int, np.ndarray]  # by class * 2^24 + slice; those of this pass

    @staticmethod
    def cut(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([counts.get(c, 0) for c in range(LAST_CLASS + 1)])
        slices = -(-n // SEGMENT)
        return slices, -(-n * WORD_BITS // (64 * np.maximum(slices, 1))) + 1

    def places(self, kind: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slice, block and mask of four bits of each hash."""
        part = (h >> np.uint64(40)) * np.uint64(self.slices[kind]) >> np.uint64(24)
        block = (h >> np.uint64(8) & np.uint64(0xFFFFFFFF)) * np.uint64(self.blocks[kind]) >> np.uint64(32)
        bits, mask = h * np.uint64(0xA24BAED4963EE407), np.zeros(len(h), np.uint64)
        for shift in (40, 46, 52, 58):
            mask |= np.uint64(1) << (bits >> np.uint64(shift) & np.uint64(63))
        return part.astype(np.int64), block.astype(np.int64), mask

    def has(self, length: int, h: np.ndarray) -> np.ndarray:
        """Which hashes of strings of one length a filter of this pass may hold."""
        kind = min(length, LAST_CLASS)
        found = np.zeros(len(h), bool)
        if not self.slices[kind]:
            return found
        part, block, mask = self.places(kind, h)
        for s in range(self.slices[kind]):
            if (words := self.held.get(kind << 24 | s)) is not None:
                at = np.flatnonzero(part == s) if self.slices[kind] > 1 else slice(None)
                found[at] = words[block[at]] & mask[at] == mask[at]
        return found


def _edits(words: list[str], alphabet: np.ndarray, shards: Shards) -> Iterator[tuple[int, str]]:
    """(row, neighbour) for edits of words of one length that the filters may hold: one letter less or a later letter.

    Insertions are deletions seen from the other word, and of a replacement one side is enough.
    """
    codes = _codes(words)
    n, length = codes.shape
    own, step = np.zeros(n, np.uint64), max(1, BLOCK // (n * len(alphabet)))
    after = np.zeros(n, np.uint64)  # the letters of a word moved one place to the front
    for p in range(0, length, step * len(alphabet)):
        at = np.arange(p, min(length, p + step * len(alphabet)))
        own += _letters(at, codes[:, at]).sum(1, dtype=np.uint64)
        after += _letters(at - 1, codes[:, at]).sum(1, dtype=np.uint64)
    before = np.full(n, length - 1, np.uint64)  # letters passed, where they are
    own += np.uint64(length)
    for p in range(0, length, step):
        at = np.arange(p, min(length, p + step))
        here = codes[:, at]
        kept, moved = _letters(at, here), _letters(at - 1, here)
        left = after[:, None] - np.cumsum(moved, 1, dtype=np.uint64)
        passed = before[:, None] + np.cumsum(kept, 1, dtype=np.uint64) - kept
        new = np.ones(here.shape, bool)  # of a run of one letter only the first is left out
        new[:, 1:] = here[:, 1:] != here[:, :-1]
        if p:
            new[:, 0] = here[:, 0] != codes[:, p - 1]
        row, place = np.nonzero(new)
        hit = shards.has(length - 1, mixed((passed + left)[row, place])) if length > 1 else np.zeros(len(row), bool)
        for i, q in zip(row[hit], place[hit], strict=True):
            yield i, words[i][: p + q] + words[i][p + q + 1 :]
        row, place, letter = np.nonzero(alphabet[None, None, :] > here[:, :, None])
        changed = own[row] - kept[row, place] + _letters(at[:, None], alphabet[None, :])[place, letter]
        hit = shards.has(length, mixed(changed))
        for i, q, a in zip(row[hit], place[hit], letter[hit], strict=True):
            yield i, words[i][: p + q] + chr(alphabet[a]) + words[i][p + q + 1 :]
        after, before = left[:, -1], passed[:, -1] + kept[:, -1]


def _segments(vocab: DataFrame, shards: Shards) -> DataFrame:
    """(segment, blocks): every filter segment from its words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, rows in pd.Series(range(len(words))).groupby([len(w) for w in words]):
                c = min(length, LAST_CLASS)
                per = max(1, BLOCK // length)
                for i in range(0, len(rows), per):
                    part, block, mask = shards.places(c, _whole(_codes([words[r] for r in rows.iloc[i : i + per]])))
                    yield pa.RecordBatch.from_arrays([pa.array(part + (c << 24)), pa.array(block), pa.array(mask.view(np.int64))], ["segment", "block", "mask"])

    def built(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        words = np.zeros(shards.blocks[int(key[0]) >> 24], np.uint64)
        np.bitwise_or.at(words, part["block"].to_numpy(), part["mask"].to_numpy().view(np.uint64))
        return pd.DataFrame({"segment": [key[0]], "blocks": [words.tobytes()]})

    made = vocab.select("word").mapInArrow(hashed, "segment long, block long, mask long")
    return made.groupBy("segment").applyInPandas(built, "segment long, blocks binary")


def near_words(vocab: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(word, n, near, near_n) of all pairs of ``vocab`` (word, n; words distinct, none empty) one edit apart, in both orders.

    Edits are generated a block at a time and probed in filters that are cut by word length, and of one length by
    slices of the hash; up to ``max_bits`` of them are broadcast a pass, and a larger vocabulary takes further passes.
    Only what a filter may hold is shuffled, to a join with the words themselves, which drops what isn't there.
    Letters are replaced by those that the vocabulary holds.
    """
    spark = vocab.sparkSession
    counts = {r["c"]: r["n"] for r in vocab.groupBy(F.least(F.char_length("word"), F.lit(LAST_CLASS)).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("l")).distinct()
    alphabet = np.array(sorted(ord(r["l"]) for r in letters.collect() if r["l"]), np.uint32)
    slices, blocks = Shards.cut(counts)
    bare = Shards(slices, blocks, {})
    made = materialised(_segments(vocab, bare), "filters")
    passes, size = [[]], 0
    for c in np.flatnonzero(slices):
        for s in range(slices[c]):
            if passes[-1] and size + 64 * blocks[c] > max_bits:
                passes.append([])
                size = 0
            passes[-1].append(int(c) << 24 | s)
            size += 64 * int(blocks[c])

    def positives(own: list[int]) -> DataFrame:
        held = {r["segment"]: np.frombuffer(r["blocks"], np.uint64) for r in made.where(F.col("segment").isin(own)).collect()}
        shared = spark.sparkContext.broadcast(Shards(slices, blocks, held))
        some = {k >> 24 for k in own}

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n")
                for length, rows in pd.Series(range(len(words))).groupby([len(w) for w in words]):
                    if not length or not some & {min(length, LAST_CLASS), min(length - 1, LAST_CLASS)}:
                        continue
                    per = max(1, BLOCK // (length * len(alphabet)))
                    for i in range(0, len(rows), per):
                        at = rows.iloc[i : i + per].to_list()
                        if found := list(_edits([words[r] for r in at], alphabet, shared.value)):
                            row = pa.array([at[r] for r, _ in found], pa.int64())
                            yield pa.RecordBatch.from_arrays([batch.column("word").take(row), n.take(row), pa.array([w for _, w in found], pa.string())], ["word", "n", "near"])

        return dealt.mapInArrow(probe, "word string, n long, near string")

    dealt = vocab.select("word", "n").repartition(max(1, -(-sum(counts.values()) // PROBED)), "word")
    found = positives(passes[0])
    for own in passes[1:]:
        found = found.unionByName(positives(own))
    pairs = found.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")
    both = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.inline(both))


def group_spellings(vocab: DataFrame, ratio: int = 2, max_bits: int = MAX_BITS) -> DataFrame:
    """Every word of ``vocab`` (word, n; words distinct) with the form it is a variant of: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (ties: the first in code-point order) if that is at least ``ratio``
    (2 or more) times as frequent. ``root`` follows forms to the last one; as counts grow at each step a chain is short,
    and it is followed by steps that double, each written to the shared folder. Words without near words have
    ``n_near`` 0, no form and themselves as root. The empty string is no word and is left out. An empty vocabulary gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    vocab = materialised(vocab.select("word", "n").where("word <> ''"), "vocabulary")
    best = near_words(vocab, max_bits).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    is_form = -F.col("b.m") >= ratio * F.col("n")
    forms = materialised(
        vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("b.near")).alias("form"), F.when(is_form, -F.col("b.m")).alias("form_n")), "forms"
    )
    scratch = Scratch(vocab.sparkSession)
    steps = scratch.write(forms.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "steps")
    while steps.where("moved").limit(1).count():
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = scratch.write(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
    return forms.join(steps.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    words = count_words(read_table(spark, sf_dir, "documents"), drop_every=97)
    return group_spellings(words.where((F.char_length("word") >= 5) & (F.col("n") >= 3)))
