"""Prefix trie of conversations from sorted matrices of turn ids, range-sharded; nodes on shard borders are recombined."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised, read_table

#: Turns in a matrix: longer conversations go on in further blocks, so padding stays bounded.
WIDTH = 16
#: Rows of a shard, which one task holds as a matrix (some 40 MB).
SHARD_ROWS = 1 << 17
ID = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
PARTS = "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, member long"
WHOLE, PARTIAL, MEMBER = 0, 1, 2


def _turns(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, family: int) -> DataFrame:
    """Turns in order, conversations of a family together and its first one first; texts as 128-bit ids."""
    c = F.col(conv_col).cast("long")
    source = convs.where(F.col(conv_col).isNotNull()).select(
        (c - c % family).alias("g"), c.alias("c"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    ordered = source.repartition("g").sortWithinPartitions("g", F.col("c") != F.col("g"), "c", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("g", "c", F.unhex(F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text"))).alias("id"), F.octet_length("text").cast("long").alias("size"))


def _blocks(turns: DataFrame, shared: int, width: int) -> DataFrame:
    """Conversations in blocks of ``width`` turns: (conv_id, block, path, sizes, full); path: digest of all turns before, then ids.

    A conversation whose last block is full has an empty one after it, so a block's rows are all members of the node
    where it begins. With ``shared`` a conversation begins with its family's first turns (crc32 of its id modulo
    ``shared``), then its own go on from there. Rows stream by: what is held is one block and the family's first turns.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, conv, first, nth, begun = None, None, [], 0, 0
        held: list[tuple] = []
        block, key, ids, sizes = 0, bytes(ID), [], []

        def add(turn: bytes, size: int) -> None:
            nonlocal block, key, ids, sizes
            ids.append(turn)
            sizes.append(size)
            if len(ids) == width:
                path = key + b"".join(ids)
                held.append((conv, block, path, sizes, True))
                block, key, ids, sizes = block + 1, hashlib.md5(path).digest(), [], []

        def close() -> None:
            nonlocal block, key, ids, sizes
            held.append((conv, block, key + b"".join(ids), sizes, False))
            block, key, ids, sizes = 0, bytes(ID), [], []

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.bool_())
            made = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True)], ["conv_id", "block", "path", "sizes", "full"])
            held.clear()
            return made

        for batch in batches:
            for g, c, turn, size in zip(*(batch.column(k).to_pylist() for k in ("g", "c", "id", "size")), strict=True):
                if c != conv:
                    if conv is not None:
                        close()
                    if g != family:
                        family, first = g, []
                    conv, nth = c, 0
                    begun = zlib.crc32(str(c).encode()) % shared if shared and c != g else 0
                    for t in first[:begun]:
                        add(*t)
                if c == g and len(first) < shared:
                    first.append((turn, size))
                if nth >= begun:
                    add(turn, size)
                nth += 1
            if len(held) > 4096:
                yield out()
        if conv is not None:
            close()
        if held:
            yield out()

    return turns.mapInArrow(cut, "conv_id long, block int, path binary, sizes array<long>, full boolean")


def _ordered(blocks: DataFrame, shards: int, width: int) -> DataFrame:
    """Range shards in the order of paths; with each row the turns that it shares with the row before (-1: not even the block)."""
    names = ["shard", "pos", "edge", "conv_id", "block", "path", "sizes", "full", "n", "lcp", "leaf", "mins"]

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(batches)):
            return
        table = pa.Table.from_batches(held).combine_chunks()
        paths = table.column("path").to_pylist()
        n = np.array([len(p) for p in paths]) // ID - 1
        deep = int(n.max())
        words = np.frombuffer(b"".join(p.ljust(ID * (deep + 1), b"\0") for p in paths), ">u8").astype(np.uint64).reshape(len(paths), -1)
        conv, block = (table.column(c).to_numpy() for c in ("conv_id", "block"))
        rows = np.lexsort((conv, *words.T[::-1], block))
        table, words, n, conv, block = table.take(pa.array(rows)), words[rows], n[rows], conv[rows], block[rows]
        changed = (words[1:] != words[:-1]).reshape(len(n) - 1, deep + 1, 2).any(2)
        changed[:, 0] |= block[1:] != block[:-1]
        starts = np.logical_or.accumulate(changed, axis=1)  # by depth: a node begins
        lcp = np.full(len(n), -1)
        lcp[1:] = np.minimum((~starts).sum(1) - 1, np.minimum(n[1:], n[:-1]))
        full = table.column("full").to_numpy(zero_copy_only=False)
        leaf = ~full
        leaf[:-1] &= lcp[1:] < n[:-1]
        edge = np.zeros(len(n), np.int32)
        edge[0] |= 1
        edge[-1] |= 2
        mins = [None] * len(n)
        before, after = np.minimum.accumulate(lcp[1:]), np.minimum.accumulate(lcp[:0:-1])
        least, last = np.minimum.accumulate(conv), np.minimum.accumulate(conv[::-1])
        mins[0] = [int(least[np.searchsorted(-before, -j, "right")]) for j in range(n[0] + 1)]
        own = [int(last[np.searchsorted(-after, -j, "right")]) for j in range(n[-1] + 1)]
        mins[-1] = own if len(n) > 1 else mins[0]
        shard = np.full(len(n), TaskContext.get().partitionId(), np.int64)
        made = (shard, np.arange(len(n)), edge, conv, block, table.column("path"), table.column("sizes"), full, n, lcp, leaf)
        whole = pa.table([*made[:5], made[5], made[6], *(pa.array(x) for x in made[7:]), pa.array(mins, pa.list_(pa.int64()))], names=names)
        yield from whole.to_batches(max_chunksize=8192)

    schema = "shard long, pos long, edge int, conv_id long, block int, path binary, sizes array<long>, full boolean, n long, lcp long, leaf boolean, mins array<long>"
    return blocks.repartitionByRange(shards, "block", "path", "conv_id").mapInArrow(order, schema)


def _borders(ordered: DataFrame) -> DataFrame:
    """(shard, side, j, least, before, after): nodes of shards' first and last rows that other shards hold too."""
    edges = ordered.where("edge > 0").select("shard", "block", "path", "mins", F.explode(F.expr("filter(array(1, 2), s -> (edge & s) > 0)")).alias("side"))
    flat = edges.select("shard", "side", "block", "path", F.posexplode("mins").alias("j", "m")).withColumn("prefix", F.expr(f"substring(path, 1, {ID} * (j + 1))"))
    nodes = flat.groupBy("block", "prefix").agg(F.min("m").alias("least"), F.min("shard").alias("low"), F.max("shard").alias("high")).where("low < high")
    return flat.join(nodes, ["block", "prefix"]).select("shard", "side", "j", "least", (F.col("low") < F.col("shard")).alias("before"), (F.col("high") > F.col("shard")).alias("after"))


def _inherited(ordered: DataFrame, borders: DataFrame) -> DataFrame:
    """(shard, pos, saved, leaves, child): what the later blocks of a conversation add to its row in an earlier one."""
    ends = borders.groupBy("shard").agg(F.max(F.expr("if(side = 1 and before, j, null)")).alias("with_last"), F.max(F.expr("if(side = 2 and after, j, null)")).alias("with_next"))
    rows = ordered.where("block > 0 or full").join(ends, "shard", "left")
    lcp = F.expr("if((edge & 1) > 0, coalesce(with_last, -1), lcp)")
    leaf = F.expr("if((edge & 2) > 0, not full and coalesce(with_next, -1) < n, leaf)")
    own = rows.withColumns({"lcp": lcp, "leaf": leaf}).select(
        "shard", "pos", "conv_id", "block",
        F.expr("aggregate(slice(sizes, 1, cast(greatest(lcp, 0) as int)), 0L, (s, x) -> s + x)").alias("saved"), F.col("leaf").cast("long").alias("leaves"), F.expr("cast(lcp < 1 and n > 0 as long)").alias("child"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.desc("block"))
    later = order.rowsBetween(Window.unboundedPreceding, -1)
    return own.select("shard", "pos", F.sum("saved").over(later).alias("saved"), F.sum("leaves").over(later).alias("leaves"), F.lag("child").over(order).alias("child")).where("saved is not null")


def _nodes(rows: pa.Table, more: pa.Table, width: int) -> pa.Table:
    """Nodes of one shard, by sums over the rows between node starts at every depth."""
    names = [f.split()[0] for f in PARTS.split(", ")]
    if not rows.num_rows:
        return pa.table([pa.array([], pa.string() if k == "ends_sha256" else pa.int32() if k == "kind" else pa.int64()) for k in names], names=names)
    rows = rows.sort_by("pos")
    conv, block, n, lcp, full, leaf = (rows.column(c).to_numpy() for c in ("conv_id", "block", "n", "lcp", "full", "leaf"))
    leaf, lcp, count = leaf.astype(np.int64), lcp.copy(), len(conv)
    bound: dict[tuple[int, int], tuple[int, bool, bool]] = {}
    extra = np.zeros((3, count), np.int64)
    for kind, pos, j, a, b, c in zip(*(more.column(k).to_pylist() for k in ("kind", "pos", "j", "a", "b", "c")), strict=True):
        if kind == 1:
            bound[pos, j] = (a, bool(b), bool(c))
        else:
            extra[:, pos] = a, b, c
    lcp[0] = max([j for (side, j), x in bound.items() if side == 1 and x[1]], default=-1)
    if leaf[-1]:
        leaf[-1] = not any(side == 2 and j >= n[-1] and x[2] for (side, j), x in bound.items())
    sizes = np.zeros((count, width + 1), np.int64)
    flat = rows.column("sizes").combine_chunks()
    lists = flat.value_lengths().to_numpy()
    sizes[np.repeat(np.arange(count), lists), np.arange(lists.sum()) - np.repeat(np.cumsum(lists) - lists, lists) + 1] = flat.flatten().to_numpy()
    sizes = np.cumsum(sizes, axis=1)
    reach = sizes[np.arange(count), np.maximum(lcp, 0)]
    ending, out, above = ~full.astype(bool), [], None
    for j in range(int(n.max()) + 1):
        start = np.flatnonzero(lcp < j)
        if not len(start) or start[0]:
            start = np.insert(start, 0, 0)
        least = np.minimum.reduceat(conv, start)
        ends = np.append(start[1:], count)
        split = np.zeros(len(start), bool)
        for side, at in ((1, 0), (2, -1)):
            if (side, j) in bound and n[0 if side == 1 else -1] >= j:
                least[at] = bound[side, j][0]
                split[at] = True
        child = ((lcp <= j) & (n > j)).astype(np.int64) if j < width else extra[2]
        saved = np.where(lcp >= j, reach - sizes[:, max(j - 1, 0)], 0) + extra[0]
        sums = [np.add.reduceat(x, start) for x in (child, leaf + extra[1], saved)]
        here = n[start] >= j
        parent = above[start] if j else np.full(len(start), -1)
        above = np.repeat(least, ends - start)
        final = (n == j) & ending  # a node's own ends are its first rows
        first_end = np.flatnonzero(final & ((np.arange(count) == 0) | (lcp < j) | ~np.append(False, final[:-1])))
        shas: dict[int, str] = {}
        node = np.repeat(np.arange(len(start)), ends - start)
        for r in first_end:
            s = int(node[r])
            stop = r
            while stop < ends[s] and final[stop]:
                stop += 1
            depth = int(block[r]) * width + j
            if (r == 0 and bound.get((1, j), (0, False, False))[1]) or (stop == count and bound.get((2, j), (0, False, False))[2]):
                out.append(([MEMBER] * (stop - r), [int(least[s])] * (stop - r), [depth] * (stop - r), *[[None] * (stop - r)] * 6, conv[r:stop].tolist()))
            else:
                shas[s] = hashlib.sha256(",".join(map(str, conv[r:stop].tolist())).encode()).hexdigest()
        inner = (j == 0) & (block[start] > 0)  # the node belongs to the block before: only its ends are here
        keep = np.flatnonzero(here & (~inner | np.isin(np.arange(len(start)), list(shas))))
        partial = split | inner | (j == width)
        zero = np.where(inner, 0, 1)
        out.append((
            np.where(partial, PARTIAL, WHOLE)[keep].tolist(), least[keep].tolist(), (block[start] * width + j)[keep].tolist(),
            [None if not j else p for p in parent[keep].tolist()], *((x * zero)[keep].tolist() for x in (ends - start, *sums)),
            [shas.get(s, None if partial[s] else NO_ENDS) for s in keep.tolist()], [None] * len(keep),
        ))
    kinds = [pa.int32(), *[pa.int64()] * 7, pa.string(), pa.int64()]
    return pa.table([pa.array([v for part in out for v in part[i]], kind) for i, kind in enumerate(kinds)], names=names)


def _hashed_members(parts: DataFrame) -> DataFrame:
    """Ends of nodes whose ends lie in several shards: their ids stream by in order, and only the running hash is held."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        names = ["conv_id", "depth", "ends_sha256"]
        made = lambda: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names)
        for batch in batches:
            for c, d, m in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "depth", "member")), strict=True):
                if (c, d) == node:
                    sha.update(b",%d" % m)
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (c, d), hashlib.sha256(b"%d" % m)
            if len(out) > 4096:
                yield made()
                out.clear()
        if node:
            out.append((*node, sha.hexdigest()))
        if out:
            yield made()

    members = parts.where(F.col("kind") == MEMBER).select("conv_id", "depth", "member")
    return members.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member").mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(
    convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = 1, shared: int = 0, width: int = WIDTH, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Nodes of the trie of all conversations: each distinct sequence of first turns (role, text), from the textless root.

    A node is named by its smallest member and its depth. Columns: conv_id, depth, parent_conv_id (null at the root),
    n_convs (members), n_children, n_leaves (childless nodes in its subtree), saved_tokens (over its subtree, members but one
    times UTF-8 bytes of the last text), ends_sha256 (of the decimal ids, joined by commas, of members with no further turn).

    Turns become 128-bit ids; conversations become rows of a matrix of ids, ``width`` turns a block. Rows are range-sharded by
    path and id, so copies of one conversation are dealt over shards too. Sorted by ``lexsort``, changes between neighbours
    that are accumulated over columns mark where nodes begin, and sums between those marks give every depth. Nodes that
    lie on a border get their smallest member from all shards' border rows (two a shard), and their sums are added up. What
    later blocks add to a row comes from a running sum over the conversation's blocks. The text is shuffled once, by family.

    Turns are ordered by ``turn`` (null first), then role and text, where turns are equal; repeated rows stay. Null roles and texts
    are empty. Rows without a conversation id belong to none. Other columns aren't read. An empty table gives no rows.

    :param family: conversations c with the same c - c % family belong together; the least of them begins a family
    :param shared: if not 0, each conversation's first h turns are those of the family's beginner (as many as it has),
        and its own follow from its h-th on; h is crc32 of its decimal id modulo ``shared``
    :param shard_rows: rows of a shard, which one task holds
    """
    if width < 1 or shard_rows < 1:
        raise ValueError("width and shard_rows must be positive")
    blocks = materialised(_blocks(_turns(convs, conv_col, turn_col, role_col, text_col, family), shared, width), "blocks")
    ordered = materialised(_ordered(blocks, max(1, -(-blocks.count() // shard_rows)), width), "ordered")
    borders = materialised(_borders(ordered), "borders")
    later = _inherited(ordered, borders)
    none = F.lit(None).cast("long")
    more = borders.select("shard", F.lit(1).alias("kind"), F.col("side").cast("long").alias("pos"), F.col("j").cast("long").alias("j"), F.col("least").alias("a"), F.col("before").cast("long").alias("b"), F.col("after").cast("long").alias("c"))
    more = more.unionByName(later.select("shard", F.lit(2).alias("kind"), "pos", none.alias("j"), F.col("saved").alias("a"), F.col("leaves").alias("b"), F.col("child").alias("c")))
    rows = ordered.select("shard", "pos", "conv_id", "block", "sizes", "full", "n", "lcp", "leaf")
    parts = materialised(rows.groupBy("shard").cogroup(more.groupBy("shard")).applyInArrow(lambda a, b: _nodes(a, b, width), PARTS), "nodes")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    partial = parts.where(F.col("kind") == PARTIAL).select(*out).unionByName(_hashed_members(parts), allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in out[3:7]]
    joined = partial.groupBy("conv_id", "depth").agg(F.max("parent_conv_id").alias("parent_conv_id"), *sums, F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
    return parts.where(F.col("kind") == WHOLE).select(*out).unionByName(joined)


def op11_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"), family=5, shared=9)
