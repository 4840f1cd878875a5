"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from phylospark.llm import spelling


def plain_counts(rows, drop_every=None):
    total = Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if drop_every and h % drop_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            total[word] += 1
    return dict(total)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(vocab, ratio=2):
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= ratio * vocab[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), vocab[form[w]] if form[w] is not None else -1) for w, n in vocab.items())


def rows_of(frame):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in frame.collect())


TEXTS = [(1, "Straße STRASSE straße über ÜBER"), (2, None), (3, ""), (None, "a b a b"), (4, "don't it's x1y"), (5, "ÿ× ÷À ŁÓdz日本"), (5, "ÿ× ÷À"), (6, "z" * 9000 + " " + "z" * 8999)]


@pytest.mark.parametrize("drop", [None, 3, 97])
def test_counts_equal_plain_ones(documents, drop):
    r = random.Random(4)
    rows = TEXTS + [(i, " ".join(r.choice(["alpha", "Beta", "gämma", "b", "cc"]) for _ in range(50))) for i in range(10, 200)]
    got = spelling.count_words(documents(rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)), drop_every=drop).collect()
    assert {x["word"]: x["n"] for x in got} == plain_counts(rows, drop) and len({x["word"] for x in got}) == len(got)


def made_up(seed, n, letters="abc", longest=7):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(1, longest))): r.choice([1, 2, 3, 4, 6, 8, 16, 50, 200]) for _ in range(n)}


@pytest.mark.parametrize("seed, segment, max_bits", [(1, 1 << 21, 1 << 29), (2, 20, 1 << 29), (3, 10, 1000)])
def test_groups_equal_plain_ones(spark, monkeypatch, seed, segment, max_bits):
    monkeypatch.setattr(spelling, "SEGMENT", segment)  # many slices, and many passes over them
    vocab = made_up(seed, 400) | {"": 5, "straße": 9, "strase": 4, "日本語日": 3, "日本語": 7} | {"ab" * 60: 4, "ab" * 60 + "c": 9, "ab" * 40 + "b": 2, "ab" * 40: 30, "ab" * 32: 3, "ab" * 31 + "a": 6}
    frame = spark.createDataFrame(list(vocab.items()), "word string, n long")
    del vocab[""]  # no word
    assert rows_of(spelling.group_spellings(frame, max_bits=max_bits)) == plain_groups(vocab)


def test_long_words_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 64)
    r = random.Random(8)
    base = ["".join(r.choice("abcdefg") for _ in range(k)) for k in (63, 64, 65, 66, 200, 900)]
    vocab = {w: 100 for w in base} | {w[:k] + w[k + 1 :]: 7 for w in base for k in (0, 13, len(w) - 1)} | {w[:20] + "z" + w[21:]: 3 for w in base}
    assert rows_of(spelling.group_spellings(spark.createDataFrame(list(vocab.items()), "word string, n long"))) == plain_groups(vocab)


def test_chains_of_forms_and_ties(spark):
    vocab = {"aaaaa"[:5 - k] + "bbbbb"[:k]: 2 ** (k + 1) for k in range(6)} | {"xxxxa": 5, "xxxxb": 20, "xxxxc": 20, "alone": 1}
    got = spelling.group_spellings(spark.createDataFrame(list(vocab.items()), "word string, n long"))
    assert rows_of(got) == plain_groups(vocab)
    assert {r["word"]: r["root"] for r in got.collect()}["aaaaa"] == "bbbbb"
    assert spelling.group_spellings(spark.createDataFrame([], "word string, n long")).count() == 0


def test_the_registered_query(documents, tmp_path):
    r = random.Random(5)
    words = ["".join(r.choice("abé") for _ in range(r.randint(4, 7))) for _ in range(150)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(300)] + [(7, rows_text) for _, rows_text in TEXTS]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = spelling.op13_spelling(documents([]).sparkSession, str(tmp_path))
    vocab = {w: n for w, n in plain_counts(rows, 97).items() if len(w) >= 5 and n >= 3}
    assert len(vocab) > 50 and rows_of(got) == plain_groups(vocab)
