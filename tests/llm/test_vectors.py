import numpy as np
from pyspark.sql import functions as F

from phylospark.llm import vectors as ops


def clustered(n, d=16, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(20, d))
    return (centres[r.integers(0, 20, n)] + 0.6 * r.normal(size=(n, d))).astype(np.float32)


def best(x, ids, q, own, k, whole=False):
    x = np.floor(1024 * x.astype(np.float64)) if whole else x.astype(np.float64)
    s = (x * x[q]).sum(axis=1)
    keep = ids != own
    order = np.lexsort((ids[keep], -s[keep]))[:k]
    return [(int(i), float(v)) for i, v in zip(ids[keep][order], s[keep][order], strict=True)]


BAD = [(9001, None), (9002, [float("nan")] * 16), (9003, [None] * 16), (9004, [float("inf")] * 16), (9005, [1.0]), (None, [1.0] * 16)]


def test_recall_against_brute_force(vectors):
    x = clustered(5000)
    ids = np.arange(len(x))
    rows = vectors([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)] + BAD + [(9100, [0.0] * 16)]).withColumn("parts", F.lit(1)).withColumn("block", F.lit(2))
    got = ops.search_learned(rows, rows.where("vec_id % 50 = 0"), k=10, sample_rows=2000, block_rows=500).collect()
    hit = n = 0
    for q in range(0, 5000, 50):
        mine = {r["vec_id"]: r["score"] for r in got if r["query_id"] == q}
        want = best(x, ids, q, q, 10)
        hit += len(mine.keys() & {i for i, _ in want})
        n += len(want)
        assert all(abs(mine[i] - s) < 1e-9 for i, s in want if i in mine)
    assert hit / n >= 0.9 and {r["query_id"] for r in got} == set(range(0, 5000, 50))


def test_ties_and_few_rows(vectors):
    rows = vectors([(i, [1.0, 0.0]) for i in (5, 3, 9, 7)] + [(0, [1.0, 1.0])])
    got = [(r["rank"], r["vec_id"], r["score"]) for r in ops.search_learned(rows, rows.where("vec_id = 0"), k=3).orderBy("rank").collect()]
    assert got == [(1, 3, 1.0), (2, 5, 1.0), (3, 7, 1.0)]
    assert ops.search_learned(rows.where("vec_id < 0"), rows.where("vec_id < 0")).count() == 0


def test_a_balanced_partition_cuts_few_links():
    x = clustered(512, seed=3).astype(float)
    graph = ops.neighbour_graph(x, 8)
    parts = ops.balanced_parts(graph, 3, 1)
    assert np.bincount(parts).tolist() == [64] * 8
    assert (parts[graph] == parts[:, None]).mean() > 0.5


def test_bounds_hold():
    r = np.random.default_rng(2)
    x, q = r.normal(size=(200, 24)), r.normal(size=(20, 24))
    exact = q @ x.T
    last = None
    for borders in ops.segment_levels(24):
        bound = ops.segment_statistics(q, borders) @ ops.segment_statistics(x, borders).T
        assert (bound >= exact - 1e-9).all() and (last is None or bound.mean() <= last)
        last = bound.mean()


def test_exact_search_equals_brute_force(vectors):
    x = clustered(1500, seed=4)
    x[700:900] = x[3]
    ids = np.arange(len(x)) * 2
    rows = vectors([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)] + BAD).withColumn("hits", F.lit(1))
    got = {}
    for r in ops.search_exact(rows, rows.where("vec_id % 100 = 0"), k=10, block_rows=300).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 3000, 100))
    for q, found in got.items():
        want = best(x, ids, q // 2, q, 10, whole=True)
        assert sorted(found) == [(k + 1, i, int(s)) for k, (i, s) in enumerate(want)]


def test_exact_search_of_huge_components_and_zeros(vectors):
    rows = vectors([(0, [2e6, 1.0]), (100, [2e6, -1.0]), (1, [0.0, 0.0]), (2, [2e6, 2.0])])
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ops.search_exact(rows, rows.where("vec_id % 100 = 0"), k=2).collect()}
    big = 1024 * 2_000_000
    assert got[0, 1] == (2, big * big + 1024 * 2048) and got[0, 2] == (100, big * big - 1024 * 1024)
    assert ops.search_exact(rows.where("vec_id < 0"), rows).count() == 0


def test_clustered_tables_of_all_sizes(vectors):
    for n, seed in ((20, 1), (130, 2), (400, 3), (1000, 4)):
        x = clustered(n, seed=seed)
        x[n // 2 : n // 2 + 5] = x[0]
        ids = np.arange(n)
        rows = vectors([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)])
        got = ops.search_learned(rows, rows.where("vec_id % 20 = 0"), k=20).collect()
        hit = want = 0
        for q in range(0, n, 20):
            mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
            near = best(x, ids, q, q, 20)
            assert [k for k, _ in mine] == list(range(1, len(near) + 1)), (n, q)
            hit += len({i for _, i in mine} & {i for i, _ in near})
            want += len(near)
        assert hit / want >= 0.95, (n, hit / want)


def test_the_registered_search(spark, vectors, tmp_path):
    x = clustered(3000, seed=6)
    vectors([(int(i), v.tolist()) for i, v in enumerate(x)] + BAD).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = ops.op2_neighbours(spark, str(tmp_path))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows, ids = got.collect(), np.arange(3000)
    hit = sum(len({r["vec_id"] for r in rows if r["query_id"] == q} & {i for i, _ in best(x, ids, q, q, 20)}) for q in range(0, 3000, 20))
    assert len(rows) == 3000 and hit / len(rows) >= 0.95


def test_bounds_drop_most_pairs_of_blockwise_vectors():
    r = np.random.default_rng(7)
    x = np.repeat(r.integers(-400, 400, (600, 4)), 8, axis=1).astype(float) + r.integers(-20, 20, (600, 32))
    q, stats = x[:30], ops.segment_levels(32)
    exact = q @ x.T
    floor = -np.sort(-exact, axis=1)[:, 10]
    survivors = (ops.segment_statistics(q, stats[2]) @ ops.segment_statistics(x, stats[2]).T >= floor[:, None]).mean()
    got = ops.top_by_bounds(q, np.arange(30), x, np.arange(600), 10)
    for i in range(30):
        order = np.lexsort((np.arange(600), -exact[i]))
        assert [v for _, v in sorted(got[i])] == [int(j) for j in order if j != i][:10]
    assert survivors < 0.2
