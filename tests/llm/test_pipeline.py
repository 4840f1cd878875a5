"""The pipeline's stages against plain versions of what they decide."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

pytestmark = pytest.mark.skipif(not (Path(__file__).resolve().parents[2] / "corpus_pipeline.py").exists(), reason="no pipeline")
DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_stages(spark):
    import corpus_pipeline as p
    from test_text import brute_components, brute_repeats, brute_secrets

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [n for n, _ in p.STAGES]
    assert names == ["language", "near_dedup", "repeats", "secrets", "packing"]
    for name, stage in p.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = p.materialised(stage(spark, docs, DATA), name)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language":
            gone = before.keys() - after.keys()
            assert len(gone) < 0.02 * len(before) and all(after[k] == before[k] for k in after)
        elif name == "near_dedup":
            want = {c for _, _, c in brute_components([(k, r["text"]) for k, r in before.items()], 5, 80)}
            assert set(after) == want
        elif name == "repeats":
            for (k, r), (removed, _, kept) in zip(before.items(), brute_repeats([r["text"] for r in before.values()], 400), strict=True):
                # no more than without repeated strings of 400 bytes; the next test holds the stage exactly, by bytes and by words
                assert len(after[k]["text"].encode()) <= len(kept) + 3 * (removed // 400 + 1) * 2
        else:
            for k, r in before.items():
                assert brute_secrets(after[k]["text"]) == []
                assert brute_secrets(r["text"]) or "[SECRET]" in after[k]["text"] or after[k]["text"] == r["text"]
    assert p.STAGES[-1][1](spark, docs, DATA).agg({"doc_id": "max"}).first()[0] is not None


def test_passages_of_over_50_words_go(spark, documents):
    import corpus_pipeline as p

    passage = " ".join(f"p{i % 10} é{i}" for i in range(26)).split()[:51]
    other = lambda name, n: [f"{name}{i}" for i in range(n)]
    short = other("s", 50)
    texts = [[*other("a", 60), *passage, *other("b", 9)], [*other("c", 7), *passage, *other("d", 60)], [*other("e", 60), *short, *other("f", 9)], [*other("g", 7), *short, *other("h", 60)], passage[:50] + other("k", 60)]
    assert len(" ".join(passage).encode()) < 210
    got = {r["doc_id"]: r["text"] for r in p.repeats(spark, documents([" ".join(t) for t in texts]), "").collect()}
    assert [got[0].split(), got[1].split()] == [other("a", 60) + other("b", 9), other("c", 7) + other("d", 60)]
    assert all(got[i] == " ".join(texts[i]) for i in (2, 3, 4))


def test_passages_of_crowded_anchors_go(spark, documents, monkeypatch):
    from phylospark.llm import substrings

    monkeypatch.setattr(substrings, "CROWD", 2)
    other = lambda name, n: [f"{name}{i}" for i in range(n)]
    texts = [[*other(f"a{k}x", 60 + k), *other("p", 51 + k % 3), *other(f"b{k}x", 55)] for k in range(7)] + [other("p", 50) + other("q", 60)]
    got = {r["doc_id"]: r["text"].split() for r in substrings.drop_repeats(documents([" ".join(t) for t in texts]), words=51).collect()}
    for k in range(7):  # p51 and p52 are in a repeated run where more than one text goes on so far
        assert got[k] == other(f"a{k}x", 60 + k) + other(f"b{k}x", 55)
    assert got[7] == texts[7]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_repeats_stage_equals_brute_force_by_bytes_and_words(spark):
    import re
    from collections import Counter

    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet").dropDuplicates(["text"])
    rows = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    words = {k: [(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^ \t-\r]+", d)] for k, d in rows.items()}
    runs = {k: [tuple(x[2] for x in w[i : i + 51]) for i in range(len(w) - 50)] for k, w in words.items()}
    strings, passages = Counter(d[i : i + 400] for d in rows.values() for i in range(len(d) - 399)), Counter(x for r in runs.values() for x in r)
    by_words = 0
    for r in p.repeats(spark, docs, DATA).collect():
        d = rows[r["doc_id"]]
        bad = bytearray(len(d))
        for i in range(len(d) - 399):
            if strings[d[i : i + 400]] > 1:
                bad[i : i + 400] = b"\1" * 400
        w, last = words[r["doc_id"]], 0
        for i, run in enumerate(runs[r["doc_id"]]):
            if passages[run] > 1:  # white space between two passages goes with them
                a, b, last = w[i - 1][1] if last and last == i else w[i][0], w[i + 50][1], i + 51
                by_words += not all(bad[a:b])
                bad[a:b] = b"\1" * (b - a)
        at, want = 0, []
        for c in d.decode():
            n = len(c.encode())
            if not all(bad[at : at + n]):
                want.append(c)
            at += n
        assert (r["text"] or "") == "".join(want)
    assert by_words


def test_near_dedup_keeps_by_row(spark, documents):
    import corpus_pipeline as p
    from test_text import words

    base = words(1, 80)
    unlike = [words(i, 60) for i in range(10, 16)]
    rows = [(None, base + " one"), (None, base + " two"), (None, base + " two"), (None, unlike[0]), (None, unlike[1]), (3, unlike[2]), (3, unlike[3]), (4, unlike[4]), (5, unlike[4]), (5, unlike[5]), (6, None), (6, ""), (None, " ")]
    got = [(r["doc_id"], r["text"]) for r in p.near_dedup(spark, documents(rows), "").collect()]
    near = [x for x in got if (x[1] or "").startswith(base)]
    assert len(near) == 1 and near[0] in rows
    rest = [x for x in got if x not in near]
    want = [(None, unlike[0]), (None, unlike[1]), (3, unlike[2]), (3, unlike[3]), (4, unlike[4]), (5, unlike[5]), (6, None), (6, ""), (None, " ")]
    assert sorted(map(str, rest)) == sorted(map(str, want))


def test_stages_on_odd_tables(spark, documents):
    import corpus_pipeline as p

    words = lambda n, x: " ".join(f"{x}word{i}" for i in range(n))
    rows = [(1, words(40, "a")), (1, words(40, "b")), (None, words(30, "c")), (None, None), (2, ""), (3, "..."), (4, words(40, "a")), (5, words(60_000, "d")), (6, "token=abcdefabcdef12")] * 2
    odd = documents(rows).withColumns({c: F.lit(c) for c in ("mark", "spans", "cls", "n", "key", "score", "__text")})
    for table in (odd, odd.where("doc_id = 99")):
        docs = table
        for name, stage in p.STAGES[:-1]:
            docs = p.materialised(stage(spark, docs, ""), name)
            assert docs.columns == table.columns
        packed = p.packing(spark, docs, "").count()
        assert (packed > 0) == (table is odd)
    stage = lambda f: sorted((str(r["doc_id"]), r["text"]) for r in f(spark, odd, "").collect())
    assert len(stage(p.language)) == 12 and all(t and "word" in t or "token" in t for _, t in stage(p.language))
    kept = stage(lambda *a: p.near_dedup(*a).where("text like '%word%' or text like '%token%'"))
    assert [k for k, _ in kept] == ["1", "1", "5", "6", "None"]
    assert len(stage(lambda s, d, x: p.near_dedup(s, d.where("text is null or length(text) < 5"), x).fillna("-", ["text"]))) == 5  # "..." is a word
    assert [t for k, t in stage(lambda s, d, x: p.secrets(s, d.where("doc_id = 6"), x))] == ["[SECRET]"] * 2
