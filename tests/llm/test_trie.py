"""The conversation trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phylospark.llm import trie

CONVS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, family=1, shared=0):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % shared if shared else 0
        built[c] = tuple(own.get(c - c % family, [])[:h] + turns[h:]) if shared else tuple(turns)
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
        ends[turns].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def made_up(seed, n, deepest, texts):
    r = random.Random(seed)
    out = []
    for c in r.sample(range(3 * n), n):
        for t in range(r.choice([1, 2, 2, 3, deepest])):
            out.append((c, r.choice([t, t, None]) if r.random() < 0.1 else t, r.choice(["user", "assistant", None]), r.choice(texts)))
    return out


@pytest.mark.parametrize("seed, shard_rows, width, deepest", [(1, 1 << 17, 16, 9), (2, 7, 16, 6), (3, 5, 2, 7), (4, 40, 3, 20), (5, 1, 1, 4)])
def test_trie_equals_a_plain_one(spark, seed, shard_rows, width, deepest):
    rows = made_up(seed, 60, deepest, ["", "a", "é", None])
    convs = spark.createDataFrame(rows, CONVS)
    for family, shared in ((1, 0), (5, 9)):
        assert rows_of(trie.prefix_trie(convs, family=family, shared=shared, width=width, shard_rows=shard_rows)) == plain(rows, family, shared)


def test_copies_and_one_long_conversation_over_shards(spark):
    rows = [(c, t, "user", "x" * t) for c in range(300) for t in range(3)]
    rows += [(1000, t, "user", "x" * (t % 5)) for t in range(200)] + [(1001, t, "user", "x" * (t % 5)) for t in range(130)] + [(1002, t, "user", "x" * (t % 5)) for t in range(128)]
    got = rows_of(trie.prefix_trie(spark.createDataFrame(rows, CONVS), shard_rows=20, width=16))
    assert got == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, 2, "user", "b"), (3, 2, "user", "a"), (3, 2, "user", "a"), (4, 0, "us", "er:x"), (5, 0, "user", ":x"), (-7, 0, "user", "é" * 3000)]
    convs = spark.createDataFrame(rows, CONVS).withColumns({"shard": F.lit("clash"), "n": F.lit(1), "depth": F.lit(None)})
    assert rows_of(trie.prefix_trie(convs)) == plain(rows)
    assert trie.prefix_trie(spark.createDataFrame([], CONVS)).count() == 0
    turnless = [(c, 0, "user", "a") for c in range(11, 15)]  # the family's beginner is absent
    assert rows_of(trie.prefix_trie(spark.createDataFrame(turnless, CONVS), family=5, shared=9)) == plain(turnless, 5, 9)


def test_the_registered_query(spark, tmp_path):
    rows = made_up(9, 200, 12, ["", "a", "b", "ß"])
    spark.createDataFrame(rows, CONVS).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(trie.op11_trie(spark, str(tmp_path))) == plain(rows, 5, 9)
