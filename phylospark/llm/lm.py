"""Language-model scoring with n-gram counts in a log-frequency Bloom filter."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, let_go, materialised, mixed, read_table, text_chunks, word_hashes

#: Counts are quantised to powers of BASE; an n-gram of level q is in the filter q times.
BASE = 1.5
PROBES, BITS_PER_ITEM = 4, 10
#: Bound on the part of the filter that every worker holds at a time: 2**30 bits are 128 MB.
MAX_BITS = 1 << 30
#: Bound on the exact counts that every worker holds: the most frequent tokens, 16 bytes each.
HOT_TOKENS = 1 << 18
#: Weight of the unigram in a bigram's probability (Dirichlet prior).
PRIOR = 20.0
END = 0x51ED270B7A1C5E03  # the hash that stands for the end of a text
_K48 = np.uint64((1 << 48) - 1)


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and where each text begins."""
    parts = [t.encode("utf-8", "replace").lower() for t in texts]
    words, places = word_hashes(b"\n".join(parts))
    borders = np.cumsum([0, *(len(p) + 1 for p in parts)])
    first = np.searchsorted(places, borders)  # words before each text
    out = np.full(len(words) + len(texts), END, np.uint64)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    out[np.arange(len(words)) + doc] = words
    return out, first + np.arange(len(texts) + 1)


def _unigram_keys(h: np.ndarray) -> np.ndarray:
    return mixed(h + np.uint64(0x1234567))


def _bigram_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A key for each token and the one before it; a text's first token follows an end."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts[:-1]] = np.uint64(END)
    return mixed(mixed(before) * np.uint64(0x9E3779B97F4A7C15) + h)


def _counted(h: np.ndarray, c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if c is None:
        return np.unique(h, return_counts=True)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    return h[first], np.add.reduceat(c, first) if len(h) else c


def _planes(keys: np.ndarray) -> bytes:
    return np.stack([(keys >> np.uint64(s)).astype(np.uint16) for s in (32, 16, 0)]).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    a, b, c = np.frombuffer(data, np.uint16).reshape(3, -1).astype(np.uint64)
    return (a << np.uint64(32)) | (b << np.uint64(16)) | c


def _by_segment(keys: np.ndarray, counts: np.ndarray, segments: int) -> pa.RecordBatch:
    """One row a segment: 48 bits of the keys seen once, of the others, and the others' counts."""
    seg = (keys >> np.uint64(48)).astype(np.int64) * segments >> 16
    once = counts == 1
    order = np.lexsort((~once, seg))
    keys, counts, seg, once = keys[order] & _K48, counts[order].astype(np.int64), seg[order], once[order]
    borders = np.searchsorted(seg, np.arange(segments + 1))
    rows = []
    for s in range(segments):
        a, b = borders[s], borders[s + 1]
        if a < b:
            m = b - int(once[a:b].sum())  # those that occur more than once come first
            rows.append((s, _planes(keys[m:b]), _planes(keys[a:m]), counts[a:m].tobytes()))
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["seg", "once", "keys", "counts"])


_PACKED = "seg int, once binary, keys binary, counts binary"


def level(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log(count)); count 1 has level 1."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def level_counts(top: int) -> np.ndarray:
    """What a level stands for: the mean of the whole counts in it, 0 for none."""
    out = np.zeros(top + 1)
    for q in range(1, top + 1):
        low, high = math.ceil(BASE ** (q - 1) - 1e-9), math.ceil(BASE**q - 1e-9) - 1
        out[q] = (low + high) / 2 if high >= low else BASE ** (q - 0.5)
    return out


def _probes(keys: np.ndarray, q: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word of a filter at which level ``q`` of each key lies, and its PROBES bits there."""
    h = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(q * 0x2545F4914F6CDD1D % (1 << 64)))
    at = ((h >> np.uint64(32)) * words) >> np.uint64(32)
    bits = np.zeros(len(h), np.uint64)
    for p in range(PROBES):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * p)) & np.uint64(63))
    return at.astype(np.int64), bits


def _segment_filter(keys: np.ndarray, counts: np.ndarray, most_bits: int) -> tuple[bytes, int, int]:
    """Bits of a segment, how many, and the least count that it holds, which is 1: every n-gram is in it.

    A segment of more than ``most_bits`` is an error, as a worker holds one segment at least.
    """
    q = level(counts)
    bits = max(64, (int(q.sum()) * BITS_PER_ITEM + 63) // 64 * 64)
    if bits > most_bits:
        raise ValueError(f"a filter segment of {bits} bits passes the bound of {most_bits}")
    filled = np.zeros(bits // 64, np.uint64)
    for i in range(1, int(q.max(initial=0)) + 1):
        keys, q = keys[q >= i], q[q >= i]
        np.bitwise_or.at(filled, *_probes(keys, i, np.uint64(len(filled))))
    return filled.tobytes(), bits, 1


@dataclass
class CountFilter:
    """Quantised counts of n-grams behind membership probes; false ones come in at about 3 %."""

    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    least: np.ndarray
    top: int = 64

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts."""
        return level_counts(self.top)[self.levels(keys)]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels are probed from 1 up until one is missing."""
        seg = (keys >> np.uint64(48)).astype(np.int64) * len(self.sizes) >> 16
        low, found = keys & _K48, np.zeros(len(keys), np.int64)
        words, starts = self.sizes >> np.uint64(6), self.starts >> 6
        live = np.flatnonzero(words[seg] > 0)
        for q in range(1, self.top + 1):
            at, bits = _probes(low[live], q, words[seg[live]])
            live = live[self.bits[at + starts[seg[live]]] & bits == bits]
            if not len(live):
                break
            found[live] = q
        return found


@dataclass
class NgramModel:
    """What scoring needs: totals, exact counts of hot tokens, the filter, and all counts as a table.

    A filter past the bound stays in the shared folder as ``segments`` and is read in ``groups`` (first
    segment, end) that keep it; ``filter`` is None then.
    """

    train_tokens: int
    vocabulary: int
    hot: np.ndarray
    hot_counts: np.ndarray
    filter: CountFilter | None
    counts: DataFrame
    segments: DataFrame
    sizes: np.ndarray
    groups: list[tuple[int, int]]


def _groups(sizes: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Runs of segments (first, end) of ``max_bits`` together, one segment at least."""
    out, first, held = [], 0, 0
    for s, size in enumerate(sizes.tolist()):
        if s > first and held + size > max_bits:
            out.append((first, s))
            first, held = s, 0
        held += size
    return [*out, (first, len(sizes))]


def _read_filter(made: DataFrame, sizes: np.ndarray, first: int, end: int) -> CountFilter:
    """The segments from ``first`` up to ``end``; all others hold nothing."""
    starts, bits = np.zeros(len(sizes), np.int64), bytearray()
    for r in made.where((F.col("seg") >= first) & (F.col("seg") < end)).toLocalIterator():  # a partition of segments at a time
        starts[r["seg"]] = 8 * len(bits)
        bits += r["data"]
    at = np.arange(len(sizes))
    own = np.where((at >= first) & (at < end), sizes, np.uint64(0))
    return CountFilter(np.frombuffer(bits, np.uint64), starts, own, np.ones(len(sizes), np.int64))


def fit_ngram_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, hot_tokens: int = HOT_TOKENS) -> NgramModel:
    """Count all tokens and bigrams of whole texts and put their quantised counts into a filter.

    Tasks count their own n-grams first; token counts are summed by a shuffle, n-gram keys travel as
    48-bit blocks a filter segment and are summed where the segment is built. The filter grows with the
    n-grams and holds all of them. Only segments (at most ``max_bits`` at a time), the ``hot_tokens`` most
    frequent tokens' counts, and totals reach the driver.
    Rows with null or empty texts are texts of one end. Empty tables give a model without counts.
    """
    texts = docs.select(F.col(text_col).alias("text"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[np.ndarray] = []
        for batch in batches:
            for _, part in text_chunks(batch, "text"):
                held.append(_hashes(part)[0])
                if sum(map(len, held)) > 4_000_000:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    def out(held: list[np.ndarray]) -> pa.RecordBatch:
        h, c = _counted(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    counts = materialised(texts.mapInArrow(tokens, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "tokens")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    segments = 1 << max(0, min(16, (total["n"] >> 16).bit_length()))

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[np.ndarray] = []
        for batch in batches:
            for _, part in text_chunks(batch, "text"):
                held.append(_bigram_keys(*_hashes(part)))
                if sum(map(len, held)) > 4_000_000:
                    yield _by_segment(*_counted(np.concatenate(held)), segments)
                    held = []
        if held:
            yield _by_segment(*_counted(np.concatenate(held)), segments)

    def unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _by_segment(_unigram_keys(np.asarray(batch.column("h")).view(np.uint64)), np.asarray(batch.column("c")), segments)

    def built(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        keys, counts = [], []
        for once, more, c in zip(part["once"], part["keys"], part["counts"], strict=True):
            keys += [_from_planes(once), _from_planes(more)]
            counts += [np.ones(len(keys[-2]), np.int64), np.frombuffer(c, np.int64)]
        data, bits, least = _segment_filter(*_counted(np.concatenate(keys), np.concatenate(counts)), MAX_BITS)
        return pd.DataFrame({"seg": [key[0]], "data": [data], "bits": [bits], "least": [least]})

    packed = texts.mapInArrow(bigrams, _PACKED).union(counts.mapInArrow(unigrams, _PACKED))
    made = materialised(packed.groupBy("seg").applyInPandas(built, "seg int, data binary, bits long, least long"), "filter")
    sizes = np.zeros(segments, np.uint64)
    for r in made.select("seg", "bits").collect():
        sizes[r["seg"]] = r["bits"]
    groups = _groups(sizes, max_bits)
    down = Window.orderBy(F.desc("c"))
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(down))
    cut = by_count.where(F.col("upto") <= hot_tokens).agg(F.min("c").alias("cut"))
    top = counts.where(F.col("c") >= cut.scalar()).toPandas()
    hot = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    whole = _read_filter(made, sizes, 0, segments) if len(groups) == 1 else None
    return NgramModel(total["n"], total["v"], hot[order], top["c"].to_numpy(np.int64)[order], whole, counts, made, sizes, groups)


def _looked_up(source: DataFrame, model: NgramModel) -> DataFrame:
    """(look, found): for each distinct text, by its mark, the levels of its tokens' n-grams from every group.

    Each pass over the texts broadcasts one group and writes the levels, a byte each, of the n-grams that
    fall in it, in the text's order: first those of the tokens, then those of the bigrams.
    """
    spark, done = source.sparkSession, None
    texts = source.select("look", "text")
    for turn, (first, end) in enumerate(model.groups):
        shared = spark.sparkContext.broadcast(_read_filter(model.segments, model.sizes, first, end))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared, first=first, end=end) -> Iterator[pa.RecordBatch]:
            part = shared.value
            for batch in batches:
                for at, texts in text_chunks(batch, "text", 2 << 20):
                    h, starts = _hashes(texts)
                    own, levels = [], []
                    for keys in (_unigram_keys(h), _bigram_keys(h, starts)):
                        own.append(_in_group(keys, len(part.sizes), first, end))
                        found = np.zeros(len(keys), np.uint8)
                        some, back = np.unique(keys[own[-1]], return_inverse=True)
                        found[own[-1]] = part.levels(some)[back]
                        levels.append(found)
                    data = [b"".join(x[a:b][o[a:b]].tobytes() for x, o in zip(levels, own, strict=True)) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("look").slice(at, len(texts)), pa.array(data, pa.binary())], ["look", "levels"])

        one = materialised(texts.mapInArrow(probe, "look long, levels binary").dropDuplicates(["look"]).withColumn("turn", F.lit(turn)), "levels")
        done = one if done is None else done.union(one)
        shared.unpersist()
    return done.groupBy("look").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "levels"))), lambda x: x.levels).alias("found"))


def _in_group(keys: np.ndarray, segments: int, first: int, end: int) -> np.ndarray:
    seg = (keys >> np.uint64(48)).astype(np.int64) * segments >> 16
    return (seg >= first) & (seg < end)


def _gathered(h: np.ndarray, starts: np.ndarray, found: list[list[bytes]], segments: int, groups: list[tuple[int, int]], table: np.ndarray) -> list[np.ndarray]:
    """Counts of each token and of each bigram from what the passes wrote."""
    keys, out = (_unigram_keys(h), _bigram_keys(h, starts)), [np.zeros(len(h)), np.zeros(len(h))]
    for turn, (first, end) in enumerate(groups):
        own = [_in_group(k, segments, first, end) for k in keys]
        for a, b, levels in zip(starts[:-1], starts[1:], found, strict=True):
            got = np.frombuffer(levels[turn], np.uint8)
            split = int(own[0][a:b].sum())
            for x, o, part in zip(out, own, (got[:split], got[split:]), strict=True):
                x[a:b][o[a:b]] = table[part]
    return out


def score_documents(docs: DataFrame, model: NgramModel, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, the ``keep`` columns, n_tokens, n_known, base_score (add-one unigrams, exact) and score.

    ``score`` is the log10 probability under bigrams: (c(h w) + PRIOR * P(w)) / (c(h) + PRIOR) with
    P(w) = (c(w) + 1) / (N + V + 1), all counts from repeated probes of the broadcast filter; of a filter past
    the bound one group of segments is broadcast a pass, and the levels found meet their texts again. For the exact
    base score, counts of hot tokens travel with the task and only other tokens meet their counts by a
    join, one row for each document and distinct token.

    Null and empty texts have one token, the end. Rows that repeat all of id, text and kept columns are
    returned as often. Other columns aren't read. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text"))
    spark, names = docs.sparkSession, ["doc_id", *keep]
    n, v, hot, hot_counts = model.train_tokens, model.vocabulary, model.hot, model.hot_counts
    shared = spark.sparkContext.broadcast(model.filter)
    segments, groups, in_passes = len(model.sizes), model.groups, model.filter is None
    if in_passes:
        source = source.withColumn("look", F.xxhash64(F.coalesce("text", F.lit(""))))
        source = source.join(_looked_up(source, model), "look").select(*names, "found", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe, logs = shared.value, np.log10(hot_counts + 1.0)
        for batch in batches:
            own = [batch.column(c) for c in names]
            for first, texts in text_chunks(batch, "text", 2 << 20):
                h, starts = _hashes(texts)
                doc = np.repeat(np.arange(len(texts)), np.diff(starts))
                words, word = np.unique(h, return_inverse=True)
                if in_passes:
                    found = batch.column("found").slice(first, len(texts)).to_pylist()
                    token, joint = _gathered(h, starts, found, segments, groups, level_counts(CountFilter.top))
                    single = np.zeros(len(words))
                    single[word] = token
                else:
                    single = probe.counts(_unigram_keys(words))
                    pairs, pair = np.unique(_bigram_keys(h, starts), return_inverse=True)
                    joint = probe.counts(pairs)[pair]
                before = np.empty(len(h), np.int64)
                before[1:] = word[:-1]
                before[starts[:-1]] = np.searchsorted(words, np.uint64(END))
                context = np.maximum(single[before], joint)
                p = (joint + PRIOR * (single[word] + 1) / (n + v + 1)) / (context + PRIOR)
                score = np.bincount(doc, np.log10(p), len(texts))
                at = np.minimum(np.searchsorted(hot, words), max(0, len(hot) - 1))
                is_hot = hot[at] == words if len(hot) else np.zeros(len(words), bool)
                value = np.where(is_hot, logs[at], 0.0) if len(hot) else np.zeros(len(words))
                lc, known = np.bincount(doc, value[word], len(texts)), np.bincount(doc, is_hot[word], len(texts)).astype(np.int64)
                cold = np.flatnonzero(~is_hot[word])
                tail, tf = np.unique(doc[cold] * np.int64(len(words)) + word[cold], return_counts=True)
                tail_doc, tail_word = tail // max(1, len(words)), tail % max(1, len(words))
                m, k = len(texts), len(tail)
                marks = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) for t in texts], np.uint64).view(np.int64)
                which = np.concatenate([np.arange(m), tail_doc])
                zeros = lambda x, kind: pa.array(np.concatenate([x, np.zeros(k, kind)]))
                ids = [c.take(pa.array(first + which)) for c in own]
                key = np.concatenate([mixed(marks.view(np.uint64)).view(np.int64), words[tail_word].view(np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(marks[which]), pa.array(key), pa.array(np.concatenate([np.zeros(m, np.int64), tf.astype(np.int64)])), zeros(np.ones(m, np.int64), np.int64), zeros(np.diff(starts).astype(np.int64), np.int64), zeros(known, np.int64), zeros(lc, float), zeros(score, float)],
                    [*names, "mark", "h", "tf", "head", "n_tokens", "n_known", "lc", "score"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*names).schema)
    split = source.mapInArrow(rows, f"{kinds}, mark long, h long, tf long, head long, n_tokens long, n_known long, lc double, score double")
    met = split.join(model.counts, "h", "left")
    met = met.withColumns({"n_known": F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0), "lc": F.col("lc") + F.when(F.col("c").isNotNull(), F.col("tf") * F.log10(F.col("c") + 1.0)).otherwise(0.0)})
    each = met.groupBy(*names, "mark").agg(F.sum("head").alias("m"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("lc").alias("lc"), F.sum("score").alias("score"))
    each = each.withColumns({c: F.expr(f"{c} div m") for c in ("n_tokens", "n_known")} | {c: F.col(c) / F.col("m") for c in ("lc", "score")})
    each = each.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int"))))
    base = F.col("lc") - F.col("n_tokens") * math.log10(n + v + 1)
    return each.select(*names, "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op1_lm(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 7) == 2)
    model = fit_ngram_model(docs.where(~F.col("held_out")))
    return score_documents(docs, model, keep=("held_out",))

