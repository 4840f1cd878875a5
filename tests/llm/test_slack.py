"""Packing by minimum bin slack: whole documents, valid bins, and few of them."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from phylospark.llm import slack, tokenize

ODD = [None, "", "   ", "a", "a", "Hello, World! <|endoftext|> it's", "éàü ŁØ ß 日本語 🎉", "tab\tand\nline\r\n\n  ", "x" * 5000, "word " * 9000]


def least_bins(counts, size):
    """A lower bound: for any k the items over size - k share no bin with those of k or more; the others fill what the middle ones leave."""
    best = 0
    for k in range(size // 2 + 1):
        long = sum(n for x, n in counts.items() if x > size - k)
        middle = [(x, n) for x, n in counts.items() if size / 2 < x <= size - k]
        room = sum((size - x) * n for x, n in middle)
        rest = sum(x * n for x, n in counts.items() if k <= x <= size / 2)
        best = max(best, long + sum(n for _, n in middle) + max(0, math.ceil((rest - room) / size)))
    return best


@pytest.mark.parametrize("seed, n, mean", [(1, 400, 5), (2, 5000, 6), (3, 3000, 7), (4, 40, 6), (5, 200_000, 5.5), (6, 3000, 7.2)])
def test_bins_are_full_and_hold_every_item(seed, n, mean):
    r, counts = random.Random(seed), defaultdict(int)
    for _ in range(n):
        counts[min(2048, max(1, int(r.lognormvariate(mean, 1))))] += 1
    bins, used = slack.fullest_bins(counts, 2048), defaultdict(int)
    for repeats, chosen in bins:
        assert sum(length * k for length, k in chosen) <= 2048
        for length, k in chosen:
            used[length] += repeats * k
    assert used == counts
    assert sum(repeats for repeats, _ in bins) <= 1.001 * least_bins(counts, 2048) + 1


def test_each_bin_is_the_fullest_beside_its_longest_item():
    r = random.Random(7)
    for _ in range(200):
        counts = {length: r.randint(1, 3) for length in r.sample(range(1, 40), r.randint(1, 8))}
        repeats, chosen = slack._filled(counts, 40, 0)[0]
        items = [length for length, k in counts.items() for _ in range(k)]
        items.remove(max(items))
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        assert sum(length * k for length, k in chosen) == max(counts) + max(s for s in sums if s + max(counts) <= 40)
    assert slack.fullest_bins({}, 10) == []
    with pytest.raises(ValueError):
        slack.fullest_bins({11: 1}, 10)


def check(rows, texts, size):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenize.tokenizer_path("byte_bpe_50k.json"))
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(texts)
    for i, text in texts.items():
        ids, at = [*tk.encode(text or "", add_special_tokens=False).ids, 0], 0
        own = sorted(by[i], key=lambda r: r["piece"])
        for k, r in enumerate(own):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert r["length"] == size or k == 0
            if "tokens" in r:
                assert r["tokens"] == part
            at += r["length"]
        assert at == len(ids) and (len(own) == 1 or len(ids) > size)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_packing_equals_the_tokenizer(documents):
    docs = documents(ODD).withColumns({"piece": F.lit("x"), "length": F.lit(0), "rank": F.lit(1)})
    check(slack.pack_minimum_slack(docs, max_tokens=256).collect(), dict(enumerate(ODD)), 256)
    assert slack.pack_minimum_slack(documents([])).count() == 0
    assert slack.pack_minimum_slack(documents([(None, "a"), (None, "a"), (1, None)])).select("sequence_id").distinct().count() == 1


def test_lengths_that_many_tasks_share(documents):
    r = random.Random(3)
    texts = [" ".join(["a"] * r.choice([1, 1, 1, 5, 30, 200])) for _ in range(500)]
    rows = slack.pack_minimum_slack(documents(texts).repartition(7), max_tokens=64).collect()
    n = check(rows, dict(enumerate(texts)), 64)
    counts = defaultdict(int)
    for row in rows:
        counts[row["length"]] += 1
    assert n <= least_bins(counts, 64) + 1


def test_the_registered_query(documents, tmp_path):
    texts = ODD + [" ".join(["ab"] * k) for k in range(300)]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = slack.op12_slack(documents([]).sparkSession, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    total = sum(r["length"] for r in rows)
    assert check(rows, dict(enumerate(texts)), 2048) <= math.ceil(total / 2048) + 1


def test_byte_bpe_equals_the_library_on_any_text():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    path = tokenize.tokenizer_path("byte_bpe_50k.json")
    own, whole = tokenize.ByteBpe(path), Tokenizer.from_file(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(["<|endoftext|>", "  ", "\n", " 's", "’", "é", "1²", "日本", "​", "ab", "İ"]) | st.text(max_size=5)))
    def same(parts):
        text = "".join(parts)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids

    same()
    long = " " * 3_000_000 + "a"  # more than the cutting pattern's stack
    assert np.frombuffer(own.encode(long), "<u4").tolist() == whole.encode(long, add_special_tokens=False).ids
