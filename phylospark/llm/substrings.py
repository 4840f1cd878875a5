"""Removal of long repeated substrings with suffix arrays built from Lyndon groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go, materialised, read_table, word_hashes

#: Bytes of the grams that anchor windows, and of the blocks that are a suffix array's symbols. Where repeats are
#: judged by words, a symbol of the text is a word's hash of 8 bytes, else a byte.
GRAM, BLOCK = 32, 32
#: Bound on the filter of repeated anchors that every worker holds: 2**29 bits are 64 MB.
FILTER_BITS = 1 << 29
#: Bytes of contexts that make one suffix array.
CHUNK = 1 << 18
#: Distinct contexts of an anchor past which its windows are counted by their hashes instead, over all tasks.
CROWD = 2048
_AT = np.uint64((1 << 24) - 1)
_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _RANDOM.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def _join(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    x = a * _STEPS[step]
    x += b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def substring_hashes(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit hashes of all substrings of the given lengths, by doubling; ``data`` are bytes or hashes of words."""
    powers, out = [_BYTES[data] if data.dtype == np.uint8 else data], []
    while 2 << (len(powers) - 1) <= max(lengths):
        h, n = powers[-1], 1 << (len(powers) - 1)
        powers.append(_join(h[:-n], h[n:], len(powers)) if len(h) > n else h[:0])
    for length in lengths:
        k = length.bit_length() - 1
        h, rest = powers[k], length - (1 << k)
        count = max(0, len(data) - length + 1)
        out.append(h[:count] if not rest else _join(h[:count], h[rest : rest + count], 15))
    return out


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of the grams that anchor the windows of ``length`` symbols.

    A window's anchor is the gram in it with the least hash, the leftmost of equals, so equal windows have
    equal anchors at equal offsets. Windows that share an anchor are consecutive.
    """
    size = GRAM // data.itemsize
    (gram,) = substring_hashes(data, (size,))
    wide = length - size + 1
    found = []
    for base in range(0, max(1, len(data) - length + 1), 1 << 23):
        part = gram[base : base + (1 << 23) + wide - 1]
        if len(part) < wide:
            break
        least = (part & ~_AT) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < wide:
            least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
        at = (least & _AT).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at)) - 1
        found.append((at[first] + base, first + base, last + base))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    p, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    return gram[p], p, first, last


# ------------------------------------------------------------------ suffix arrays from Lyndon groups


def lyndon_groups(order: list[int], start: list[int]) -> tuple[list[int], list[int]]:
    """Group all suffixes by their longest Lyndon prefix; also each one's previous smaller suffix.

    ``order`` has the positions sorted by symbol, ``start`` each position's first place in it; the last
    symbol is the least and occurs once. Members of a group and counts of pointers are put in order by a comparison
    sort, so the construction is linear but for those sorts. Groups are finished from the largest down: a finished group's
    members point to the nearest earlier suffix of a smaller group, and the suffixes pointed to move
    behind their own group, those with more pointers further back, since the finished prefix extends theirs.
    """
    n = len(order)
    sa, gr, prev = order[:], start[:], [-1] * n
    place, ends = [0] * n, {}
    for k, i in enumerate(sa):
        place[i] = k
        ends[gr[i]] = k
    e = n - 1
    while e >= 0:
        g = gr[sa[e]]
        count: dict[int, int] = {}
        for i in sorted(sa[g : e + 1]) if g < e else (sa[e],):
            j = i - 1
            while j >= 0 and gr[j] >= g:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        e = g - 1
        for times in sorted(set(count.values()), reverse=True):
            by_group: dict[int, list[int]] = {}
            for j, c in count.items():
                if c == times:
                    by_group.setdefault(gr[j], []).append(j)
            for old, moved in by_group.items():
                end = ends[old]
                new = end - len(moved) + 1
                if new == old:
                    continue
                back = end
                for j in moved:
                    k, other = place[j], sa[back]
                    sa[k], sa[back], place[other], place[j] = other, j, k, back
                    back -= 1
                    gr[j] = new
                ends[new], ends[old] = end, new - 1
    return gr, prev


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a string whose last symbol is the least and occurs once.

    From the groups, one pass from the smallest suffix up places each suffix's chain of previous smaller
    ones at the front of their groups; nothing is renamed and nothing recurs.
    """
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    start = np.empty(len(order), np.int64)
    start[order] = starts
    gr, prev = lyndon_groups(order.tolist(), start.tolist())
    n = len(gr)
    sa, front, placed = [-1] * n, list(range(n)), [False] * n
    sa[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = sa[k] - 1
        while j >= 0 and not placed[j]:
            g = gr[j]
            sa[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = prev[j]
    return np.array(sa)


def common_prefixes(symbols: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """How many symbols each suffix shares with the one before it in the suffix array, in text order's linear time."""
    s, order = symbols.tolist(), sa.tolist()
    place = [0] * len(order)
    for k, i in enumerate(order):
        place[i] = k
    out, same = [0] * len(order), 0
    for i, k in enumerate(place):
        if k:
            j = order[k - 1]
            while s[i + same] == s[j + same]:
                same += 1
            out[k] = same
            same = max(0, same - 1)
        else:
            same = 0
    return np.array(out)


def repeated_windows(contexts: list[bytes], offsets: list[int], length: int, symbol: type = np.uint8) -> list[list[tuple[int, int]]]:
    """Per context, ranges (first, last) of the windows of ``length`` symbols that another place holds too.

    Contexts are cut into blocks counted from their anchor. In the suffix array over the blocks, neighbours whose
    common prefix has as many whole blocks as any window lie in one group; a window is repeated only if
    another of its group has the same symbols on either side too, which the hash of all of them tells.
    """
    data = np.frombuffer(b"".join(contexts), symbol)
    wide = BLOCK // data.itemsize
    sizes = np.array([len(c) // data.itemsize for c in contexts])
    begins = np.cumsum(sizes) - sizes
    whole = (length - wide + 1) // wide
    (block, window) = substring_hashes(data, (wide, length))
    lead = np.array(offsets) % wide
    counts = np.maximum((sizes - lead) // wide, 0)
    owner = np.repeat(np.arange(len(contexts)), counts + 1)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts + 1) - counts - 1, counts + 1)
    at = begins[owner] + lead[owner] + nth * wide
    is_end = nth == counts[owner]
    _, rank = np.unique(block[at[~is_end]], return_inverse=True)
    symbols = np.empty(len(owner), np.int64)
    symbols[~is_end] = rank + len(contexts)
    symbols[is_end] = np.arange(len(contexts))[::-1]  # ends differ; the last one is the least
    sa = suffix_array(symbols)
    same = common_prefixes(symbols, sa) >= whole
    group = np.cumsum(~same)
    close = same.copy()
    close[:-1] |= same[1:]
    near, group = sa[close], group[close]
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if not len(near):
        return out
    starts = (at[near][:, None] - np.arange(wide)[None, :]).ravel()
    own, group = np.repeat(owner[near], wide), np.repeat(group, wide)
    fits = (starts >= begins[own]) & (starts + length <= (begins + sizes)[own])
    starts, group = starts[fits], group[fits]
    order = np.lexsort((window[starts], group))
    starts, group = starts[order], group[order]
    equal = (window[starts][1:] == window[starts][:-1]) & (group[1:] == group[:-1])
    twice = np.zeros(len(starts), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    starts = np.unique(starts[twice])
    if not len(starts):
        return out
    own = np.searchsorted(begins, starts, side="right") - 1
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(starts) > 1) | (np.diff(own) > 0)]))
    for a, b in zip(cut, np.append(cut[1:], len(starts)) - 1, strict=True):
        out[own[a]].append((int(starts[a] - begins[own[a]]), int(starts[b] - begins[own[a]])))
    return out


# ------------------------------------------------------------------ the operator


class _Filter:
    """Membership of hashes with some false positives, in segments of their top bits."""

    def __init__(self, parts: list[tuple[int, bytes]], segments: int):
        self.segments = segments
        self.sizes = np.zeros(segments, np.uint64)
        for s, data in parts:
            self.sizes[s] = 8 * len(data)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes.astype(np.int64))[:-1]])
        self.bits = np.frombuffer(b"".join(d for _, d in sorted(parts)), np.uint8)

    @staticmethod
    def positions(h: np.ndarray, sizes) -> Iterator[np.ndarray]:
        for step in (3, 5, 7, 9):
            x = h * _STEPS[step]
            yield ((x ^ (x >> np.uint64(32))) % sizes).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, most: int) -> bytes:
        bits = np.zeros(max(64, min(most, (10 * len(h) + 63) // 64 * 64)), bool)
        for at in cls.positions(h, np.uint64(len(bits))):
            bits[at] = True
        return np.packbits(bits).tobytes()

    def holds(self, h: np.ndarray) -> np.ndarray:
        seg = (h >> np.uint64(52)).astype(np.int64) * self.segments >> 12
        sizes = self.sizes[seg]
        out = sizes > 0
        for at in self.positions(h, np.maximum(sizes, np.uint64(1))):
            at = np.where(out, at + self.starts[seg], 0)
            if len(self.bits):
                out &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return out


def _symbol(by_words: bool) -> type:
    return np.uint64 if by_words else np.uint8


def _symbols(text: str | None, by_words: bool) -> np.ndarray:
    """The UTF-8 bytes of a text, or a hash for each of its words."""
    data = (text or "").encode("utf-8", "replace")
    return word_hashes(data)[0] if by_words else np.frombuffer(data, np.uint8)


def _repeated_anchors(source: DataFrame, length: int, by_words: bool) -> _Filter:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[np.ndarray] = []
        for batch in batches:
            for value in batch.column("text"):
                data = _symbols(value.as_py(), by_words)
                if len(data) >= length:
                    held.append(anchors(data, length)[0])
        if held:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    counted = source.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h")
    repeated = materialised(counted, "anchors")
    n = repeated.count()
    segments = 1 << max(0, min(10, (n >> 15).bit_length()))
    seg = F.shiftright(F.shiftrightunsigned("h", 52) * segments, 12).cast("int")

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"seg": [key[0]], "data": [_Filter.build(part["h"].to_numpy(np.int64).view(np.uint64), FILTER_BITS // segments)]})

    parts = repeated.withColumn("seg", seg).groupBy("seg").applyInPandas(build, "seg int, data binary").collect()
    return _Filter([(r["seg"], bytes(r["data"])) for r in parts], segments)


_OCCURRENCES = "h long, cx long, mark long, doc string, first int, n long, off int, context binary"


def _occurrences(source: DataFrame, repeated: _Filter, length: int, by_words: bool) -> DataFrame:
    """Places of repeated anchors, and each task's distinct contexts with their numbers of places.

    A context spans the windows of its anchor; ``cx`` tells contexts and anchor offsets apart.
    """
    shared = source.sparkSession.sparkContext.broadcast(repeated)

    def out(places: list[tuple], contexts: dict) -> pa.RecordBatch:
        rows = [(h, cx, mark, doc, first, None, None, None) for h, cx, mark, doc, first in places] + [(h, cx, None, None, None, *x) for (h, cx), x in contexts.items()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "cx", "mark", "doc", "first", "n", "off", "context"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        wanted, places, contexts, size = shared.value, [], {}, 0
        for batch in batches:
            for doc, mark, value in zip(batch.column("doc").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"), strict=True):
                data = _symbols(value.as_py(), by_words)
                if len(data) < length:
                    continue
                h, p, first, last = anchors(data, length)
                keep = np.flatnonzero(wanted.holds(h))
                for hash_, at, a, b in zip(h[keep].view(np.int64).tolist(), p[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
                    context = data[a : b + length].tobytes()
                    cx = xxhash.xxh3_64_intdigest(context, at - a) - (1 << 63)
                    places.append((hash_, cx, mark, doc, a))
                    known = contexts.get((hash_, cx))
                    if known:
                        known[0] += 1
                    else:
                        contexts[hash_, cx] = [1, at - a, context]
                        size += len(context)
                if size > 32 << 20 or len(places) > 300_000:
                    yield out(places, contexts)
                    places, contexts, size = [], {}, 0
        yield out(places, contexts)

    return source.select("doc", "mark", "text").mapInArrow(find, _OCCURRENCES)


def _ranges(contexts: DataFrame, length: int, symbol: type) -> DataFrame:
    """(h, cx, a, b): ranges of repeated windows in each context, from suffix arrays over anchors' contexts."""
    unit = np.dtype(symbol).itemsize

    def solve(groups: list[list[list]]) -> pa.RecordBatch:
        rows, open_ = [], []
        for group in groups:
            for item in group:
                if item[2] > 1:
                    rows.append((item[0], item[1], 0, len(item[4]) // unit - length))
            if len(group) > 1:
                open_ += group
        if open_:
            found = repeated_windows([x[4] for x in open_], [x[3] for x in open_], length, symbol)
            rows += [(x[0], x[1], a, b) for x, r in zip(open_, found, strict=True) if x[2] == 1 for a, b in r]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["h", "cx", "a", "b"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        groups: list[list[list]] = []
        size = 0
        for batch in batches:
            for h, cx, n, off, context in zip(*(batch.column(c).to_pylist() for c in ("h", "cx", "n", "off", "context")), strict=True):
                if not groups or groups[-1][0][0] != h:
                    if size > CHUNK:
                        yield solve(groups)
                        groups, size = [], 0
                    groups.append([])
                if groups[-1] and groups[-1][-1][1] == cx:
                    groups[-1][-1][2] += n
                else:
                    groups[-1].append([h, cx, n, off, context])
                    size += len(context)
        if groups:
            yield solve(groups)

    dealt = contexts.repartition("h").sortWithinPartitions("h", "cx")
    return dealt.select("h", "cx", "n", "off", "context").mapInArrow(stream, "h long, cx long, a int, b int")


def _crowded_ranges(contexts: DataFrame, length: int, symbol: type) -> DataFrame:
    """The same for anchors of very many contexts: their windows' hashes are counted by a shuffle, whoever holds them."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for first in range(0, batch.num_rows, 64):  # some 25 000 windows at most
                part = batch.slice(first, 64)
                hashed = [substring_hashes(np.frombuffer(c, symbol), (length,))[0] for c in part.column("context").to_pylist()]
                times = [len(w) for w in hashed]
                columns = [np.repeat(part.column(c).to_numpy(), times) for c in ("h", "cx", "n")]
                columns += [np.concatenate([np.arange(t, dtype=np.int32) for t in times]), np.concatenate(hashed).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "cx", "n", "at", "w"])

    found = contexts.select("h", "cx", "n", "context").mapInArrow(windows, "h long, cx long, n long, at int, w long")
    repeated = found.groupBy("h", "w").agg(F.sum("n").alias("times")).where("times > 1").select("h", "w")
    met = found.join(repeated, ["h", "w"]).select("h", "cx", "at").distinct()
    return met.select("h", "cx", F.col("at").alias("a"), F.col("at").alias("b"))


def _spans(docs: DataFrame, length: int, id_col: str, text_col: str, by_words: bool = False) -> DataFrame:
    """(doc, mark, span) of every range of repeated windows, in bytes of the text or in its words."""
    source = docs.select(F.col(id_col).cast("string").alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"), F.col(text_col).alias("text"))
    symbol = _symbol(by_words)
    found = materialised(_occurrences(source, _repeated_anchors(source, length, by_words), length, by_words), "contexts")
    contexts = found.where("n is not null")
    crowds = materialised(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CROWD).select("h"), "crowds")
    ranges = _ranges(contexts.join(crowds, "h", "left_anti"), length, symbol).union(_crowded_ranges(contexts.join(crowds, "h", "left_semi"), length, symbol))
    places = found.where("n is null").select("h", "cx", "mark", "doc", "first")
    met = places.join(ranges, ["h", "cx"]).select("doc", "mark", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))
    return met.select("doc", "mark", F.struct("a", (F.col("b") + length).alias("b")).alias("span"))


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with repeats: its id as text, the text's mark (xxhash64) and ``spans``.

    Spans are the ranges (a, b) of places whose byte lies in a string of ``length`` bytes that also starts
    elsewhere, in this or any other document, as merged ranges of the text's UTF-8 bytes.
    """
    return _spans(docs, length, id_col, text_col).groupBy("doc", "mark").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def _merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in spans or ():
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [(a, b) for a, b in out]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to the characters that they cover whole."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _word_bytes(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of bytes, from the first word's first byte to the last one's end."""
    starts, sizes = word_hashes(data)[1], [len(w) for w in data.split()]
    return [(int(starts[a]), int(starts[b - 1]) + sizes[b - 1]) for a, b in spans]


def _with_spans(docs: DataFrame, length: int, id_col: str, text_col: str, words: int | None = None) -> DataFrame:
    found = _spans(docs, length, id_col, text_col).withColumn("by_words", F.lit(False))
    if words:
        found = found.union(_spans(docs, words, id_col, text_col, by_words=True).withColumn("by_words", F.lit(True)))
    of_kind = lambda is_kind: F.array_sort(F.collect_set(F.when(is_kind, F.col("span"))))
    spans = found.groupBy(F.col("doc").alias("__doc"), F.col("mark").alias("__mark")).agg(of_kind(~F.col("by_words")).alias("__spans"), of_kind(F.col("by_words")).alias("__word_spans"))
    marked = docs.withColumns({"__doc": F.col(id_col).cast("string"), "__mark": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    on = marked["__doc"].eqNullSafe(spans["__doc"]) & (marked["__mark"] == spans["__mark"])
    return marked.join(spans, on, "left").drop("__doc", "__mark")


def drop_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", words: int | None = None) -> DataFrame:
    """``docs`` with every repeated string of ``length`` bytes or more cut from its text.

    With ``words``, so is every repeated run of so many words or more, however few bytes it has; words are
    what is left between ASCII white space, and are compared by 64-bit hashes. White space inside a run, or
    between two that follow each other, goes with them.

    All places of a repeated string lose it, as for the training of language models; characters that lie
    only partly in a repeat stay. Strings are judged on the input, matches never cross documents.

    Every window of ``length`` bytes is anchored at its gram of least hash. Anchors that occur once are
    dropped by a filter of fixed size; the rest's contexts meet by anchor, equal contexts as one with a
    count, and common prefixes in suffix arrays from Lyndon groups find which windows occur twice. A task holds the
    contexts of an anchor, CROWD of less than two lengths at most; of an anchor with more of them the windows' hashes are counted. Texts travel once, to meet
    their spans. Null texts stay null; repeated rows are each other's repeats; an empty table stays empty.
    """
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, column = [], names.index(text_col)
            for value, spans, runs in zip(batch.column(column), batch.column("__spans"), batch.column("__word_spans"), strict=True):
                text, spans, runs = value.as_py(), _merge(spans.as_py()), _merge(runs.as_py())
                if text and (spans or runs):
                    data = text.encode("utf-8", "replace")
                    both = sorted(spans + _word_bytes(data, runs)) if runs else spans
                    spans = _merge([{"a": a, "b": b} for a, b in both])
                    text = _kept(data, _whole_characters(data, spans)).decode("utf-8", "ignore")
                texts.append(text)
            arrays = [pa.array(texts, pa.string()) if i == column else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return _with_spans(docs, length, id_col, text_col, words).mapInArrow(cut, docs.schema)


def op7_substrings(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans_, kept, left = [], [], [], [], []
            for value, found in zip(batch.column("text"), batch.column("__spans"), strict=True):
                data, spans = (value.as_py() or "").encode("utf-8", "replace"), _merge(found.as_py())
                size.append(len(data))
                removed.append(sum(b - a for a, b in spans))
                spans_.append(len(spans))
                rest = _kept(data, spans)
                kept.append(hashlib.sha256(rest).hexdigest())
                left.append(rest.decode("utf-8", "ignore"))
            longs = [pa.array(x, pa.int64()) for x in (size, removed, spans_)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *longs, pa.array(kept, pa.string()), pa.array(left, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_spans(docs, 400, "doc_id", "text").mapInArrow(digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
