"""Nearest rows by inner product: learned partitions (approximate) and segment statistics (exact)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised, read_table

_HITS = "array<struct<neg:double,vec_id:long>>"
_WHOLE_HITS = "array<struct<neg:long,vec_id:long>>"


def usable_vectors(frame: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> tuple[DataFrame, int, int]:
    """(vec_id, v array<double>), dimension and count of the rows that take part.

    Those have an id and a vector of the most frequent dimension whose components are all finite
    (and, with ``nonzero``, not all zero).
    """
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0) & finite)
    if nonzero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return rows, 0, 0
    return rows.where(F.size("v") == sizes[0]["d"]), sizes[0]["d"], sizes[0]["count"]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _stacked(column: pd.Series, d: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, d))


def _merged(hits: DataFrame, k: int, score_type: str) -> DataFrame:
    """The k best of each query from its blocks' best, a rank each."""
    best = hits.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits"))
    flat = best.select("query_id", F.posexplode("hits").alias("pos", "hit"))
    return flat.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.neg")).cast(score_type).alias("score"))


# --------------------------------------------------------------------------- learned partitions


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product of each row, the row itself left out."""
    out = np.empty((len(x), k), np.int64)
    for first in range(0, len(x), 512):
        s = x[first : first + 512] @ x.T
        s[np.arange(len(s)), first + np.arange(len(s))] = -np.inf
        out[first : first + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, depth: int, seed: int) -> np.ndarray:
    """2**depth parts of equal size by recursive bisection with balanced exchanges.

    A split starts from the median of a vector smoothed over the graph; then pairs of rows on either
    side are exchanged while that cuts fewer links, best gains first.
    """
    rng = np.random.default_rng(seed)
    n, k = graph.shape
    parts = np.zeros(n, np.int64)
    a = np.concatenate([np.repeat(np.arange(n), k), graph.ravel()])
    b = np.concatenate([graph.ravel(), np.repeat(np.arange(n), k)])
    for _ in range(depth):
        inner = parts[a] == parts[b]
        u, w = a[inner], b[inner]
        links = np.maximum(np.bincount(u, minlength=n), 1)
        value = rng.normal(size=n)
        for _ in range(40):
            value = 0.5 * value + 0.5 * np.bincount(u, value[w], n) / links
            for mean_of in (np.bincount(parts, value) / np.bincount(parts),):
                value -= mean_of[parts]
            value /= np.abs(value).max() + 1e-300
        order = np.lexsort((value, parts))
        sizes = np.bincount(parts)
        starts = np.cumsum(sizes) - sizes
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - starts[parts[order]]
        side = place >= (sizes[parts] + 1) // 2
        for _ in range(12):
            gain = np.bincount(u, np.where(side[u] != side[w], 1.0, -1.0), n) + 1e-3 * rng.random(n)
            moved = False
            for p in range(len(sizes)):
                rows = np.flatnonzero(parts == p)
                left, right = rows[~side[rows]], rows[side[rows]]
                left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
                m = min(len(left), len(right))
                better = int((gain[left[:m]] + gain[right[:m]] > 1).sum())
                better = (better + 1) // 2  # half at a time: gains change as neighbours move
                if better:
                    side[left[:better]], side[right[:better]], moved = True, False, True
            if not moved:
                break
        parts = 2 * parts + side
    return parts


@dataclass
class Router:
    """A small classifier from vectors to parts, and how many parts a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def _train_router(x: np.ndarray, target: np.ndarray, hidden: int, epochs: int, seed: int) -> Router:
    """Soft labels (parts of a row's neighbours), cross-entropy, Adam in numpy."""
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    d, m = x.shape[1], target.shape[1]
    params = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, m)), np.zeros(m)]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            at = order[i : i + 128]
            h = x[at] @ params[0] + params[1]
            r = np.maximum(h, 0)
            z = r @ params[2] + params[3]
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - target[at]) / len(at)
            gh = (g @ params[2].T) * (h > 0)
            t += 1
            step = 3e-3 * (1 - epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for j, grad in enumerate((x[at].T @ gh, gh.sum(0), r.T @ g, g.sum(0))):
                first[j] += 0.1 * (grad - first[j])
                second[j] += 0.001 * (grad * grad - second[j])
                params[j] -= step * first[j] / (np.sqrt(second[j]) + 1e-8)
    return Router(*params)


def fit_router(sample: np.ndarray, parts: int, k: int, recall: float, hidden: int = 128, epochs: int = 24, seed: int = 11) -> Router:
    """Partition the sample's neighbour graph, learn to route, and set the probes for ``recall``.

    The recall of a number of probes is measured on a quarter of the sample that training leaves out,
    as queries against the whole sample.
    """
    n = len(sample)
    k = max(1, min(k, n - 1))
    parts = min(parts, 1 << max(0, (n // 8).bit_length() - 1))  # eight rows a part at least
    if parts == 1:
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(sample, k)
    label = balanced_parts(graph, parts.bit_length() - 1, seed)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), k), label[graph].ravel()), 1 / (k + k // 2))
    target[np.arange(n), label] += 1 - k / (k + k // 2)
    held = np.arange(n) % 4 == 0
    router = _train_router(sample[~held], target[~held], hidden, epochs, seed)
    scores = router.scores(sample)
    own = scores.argmax(1)
    place = np.argsort(np.argsort(-scores[held], axis=1), axis=1)
    visits = np.take_along_axis(place, own[graph[held]], axis=1)
    reached = [(visits < p).mean() for p in range(1, parts + 1)]
    router.probes = next((p for p, r in enumerate(reached, 1) if r >= recall), parts)
    return router


def search_learned(
    frame: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", sample_rows: int = 4096, recall: float = 0.97, block_rows: int = 8192, parts: int | None = None
) -> DataFrame:
    """Each query's k nearest rows by inner product, found in learned partitions.

    A router is fitted on the ``sample_rows`` rows with the least hash of their id (the only rows that
    the driver sees): the sample's neighbour graph is cut into balanced parts and a small classifier
    learns the parts of a row's neighbours. Every row is indexed in its likeliest part; a query visits as
    many of its likeliest parts as a left-out quarter of the sample needs for ``recall``. Parts are dealt
    in blocks of about ``block_rows`` rows by a hash of the id, so a large part, or one vector that many
    rows repeat, spreads over tasks; queries of a block pass in chunks. Candidates' scores are the inner
    products in double precision; ties go to the smaller id. A query whose parts hold fewer than k other rows
    visits the remaining parts too, so it gets k rows wherever the table has them.

    ``queries`` are rows of the same columns; a row of the same id isn't its own neighbour. Rows whose
    vector is null, zero, of another dimension, or holds null or non-finite components take no part on
    either side. Rows that repeat an id each count. Other columns aren't read. Empty tables give no rows.
    """
    rows, d, n = usable_vectors(frame, id_col, vec_col, True)
    asked = queries.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    v = F.col("v")
    asked = asked.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") == d) & F.exists(v, lambda x: x != 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    if parts is None:
        parts = 1 << max(4, min(8, (max(n, 1) // 2048).bit_length()))
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect() if n else []
    sample = np.array([r["v"] for r in sorted(drawn, key=lambda r: r["vec_id"])], np.float64).reshape(len(drawn), d)
    router = fit_router(sample, parts, k, recall)
    probes = router.probes

    def placed(batches: Iterator[pa.RecordBatch], wanted: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = router.scores(_matrix(batch.column("v"), d))
                best = np.argsort(-scores, axis=1, kind="stable")[:, :wanted]
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(list(best.astype(np.int32)), kind)], ["vec_id", "v", "parts"])

    schema = "vec_id long, v array<double>, parts array<int>"
    indexed = rows.mapInArrow(lambda b: placed(b, 1), schema).select("vec_id", "v", F.element_at("parts", 1).alias("part"))
    sizes = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()} if n else {}
    width = F.element_at(F.array(*[F.lit(max(1, -(-sizes.get(p, 0) // block_rows))) for p in range(parts)]), F.col("part") + 1)
    indexed = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), width).cast("int"))
    in_blocks = lambda f: f.withColumn("block", F.explode(F.sequence(F.lit(0), (width - 1).cast("int"))))
    sent = asked.mapInArrow(lambda b: placed(b, probes), schema).select("vec_id", "v", F.explode("parts").alias("part"))

    def nearest(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "hits"]
        if not len(own) or not len(asked):
            return pd.DataFrame([], columns=names)
        own = own.sort_values("vec_id")
        x, ids, found = _stacked(own["v"], d), own["vec_id"].to_numpy(), []
        q_all, q_ids = _stacked(asked["v"], d), asked["vec_id"].to_numpy()
        take = min(len(ids), k + 4)
        for first in range(0, len(q_all), 256):
            q, qi = q_all[first : first + 256], q_ids[first : first + 256]
            s = q @ x.T
            s[qi[:, None] == ids[None, :]] = -np.inf
            floor = np.partition(s, len(ids) - take, axis=1)[:, len(ids) - take]
            for r in range(len(q)):
                near = np.flatnonzero((s[r] >= floor[r] - 1e-9 * abs(floor[r])) & (s[r] > -np.inf))
                exact = (x[near] * q[r]).sum(axis=1)
                best = np.lexsort((ids[near], -exact))[:k]
                found.append((qi[r], [(-float(exact[j]), int(ids[near[j]])) for j in best]))
        return pd.DataFrame(found, columns=names)

    def met(sent: DataFrame) -> DataFrame:
        return indexed.groupBy("part", "block").cogroup(in_blocks(sent).groupBy("part", "block")).applyInPandas(nearest, f"query_id long, hits {_HITS}")

    hits = met(sent)
    if n and probes < len(sizes):
        hits = materialised(hits, "hits")
        enough = hits.groupBy(F.col("query_id").alias("vec_id")).agg(F.sum(F.size("hits")).alias("found")).where(F.col("found") >= k)
        short = materialised(asked.join(enough, "vec_id", "left_anti"), "short")
        if not short.limit(1).count():
            return _merged(hits, k, "double")
        rest = F.array_except(F.array(*[F.lit(p) for p in sizes]), F.slice("parts", 1, probes))
        far = short.mapInArrow(lambda b: placed(b, probes), schema).select("vec_id", "v", F.explode(rest).alias("part"))
        hits = hits.union(met(far))
    return _merged(hits, k, "double")


def op2_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return search_learned(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


# --------------------------------------------------------------------------- segment statistics


def segment_levels(d: int) -> list[np.ndarray]:
    """Borders of 1, 2, 4 ... segments over d components, while segments have two or more."""
    levels, n = [], 1
    while n == 1 or 2 * n <= d:
        levels.append(np.linspace(0, d, n + 1).astype(int)[:-1])
        n *= 2
    return levels


def segment_statistics(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Means and deviations of each segment, scaled by the root of its length: [rows, 2 * segments].

    For rows x and y of a segment of length w, the inner product is at most w (mean mean + dev dev),
    which is the same as the lower bound w ((mean - mean)^2 + (dev - dev)^2) on the squared distance.
    """
    w = np.diff(np.append(borders, x.shape[1]))
    mean = np.add.reduceat(x, borders, axis=1) / w
    square = np.add.reduceat(x * x, borders, axis=1) / w
    dev = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, dev], axis=1) * np.sqrt(np.concatenate([w, w]))


def top_by_bounds(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per query its k best (-score, id) among ``x`` (rows sorted by id): coarse to fine, then exact."""
    d = x.shape[1]
    levels = segment_levels(d)
    stats = [(segment_statistics(q, b), segment_statistics(x, b)) for b in levels]
    whole = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * d < 2**52
    slack = 1e-9 * (np.linalg.norm(q, axis=1).max(initial=0) * np.linalg.norm(x, axis=1).max(initial=0) + 1)

    def exact(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        if whole:
            return np.einsum("ij,ij->i", q[rows], x[columns])
        return np.array([sum(int(a) * int(b) for a, b in zip(q[r], x[c], strict=True)) for r, c in zip(rows, columns, strict=True)], object)

    bound = stats[0][0] @ stats[0][1].T
    bound[q_ids[:, None] == ids[None, :]] = -np.inf
    take = min(k, len(ids))
    seeds = np.argpartition(-bound, take - 1, axis=1)[:, :take]
    rows = np.repeat(np.arange(len(q)), take)
    got = np.where(bound[rows, seeds.ravel()] > -np.inf, exact(rows, seeds.ravel()).astype(float), -np.inf)
    floor = got.reshape(len(q), take).min(axis=1) if len(ids) > k else np.full(len(q), -np.inf)
    r, c = np.nonzero((bound >= floor[:, None] - slack) & (bound > -np.inf))
    for (a, b), segments in zip(stats[1:], levels[1:], strict=True):
        if len(segments) > 1 and len(r) > 0.2 * bound.size:  # so many pairs: one product serves all
            keep = (a @ b.T)[r, c] >= floor[r] - slack
        else:
            keep = np.einsum("ij,ij->i", a[r], b[c]) >= floor[r] - slack
        r, c = r[keep], c[keep]
    if whole and len(r) > 0.2 * bound.size:
        score = (q @ x.T)[r, c]
    else:
        score = np.concatenate([exact(r[i : i + 100_000], c[i : i + 100_000]) for i in range(0, len(r), 100_000)]) if len(r) else np.zeros(0)
    order = np.lexsort((ids[c], -score.astype(float), r)) if whole else np.array(sorted(range(len(r)), key=lambda i: (r[i], -score[i], ids[c[i]])), int)
    r, c, score = r[order], c[order], score[order]
    place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(q))]
    for i in np.flatnonzero(place < k):
        best[r[i]].append((-int(score[i]), int(ids[c[i]])))
    return best


def search_exact(frame: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 8192) -> DataFrame:
    """Each query's k highest integer inner products over floor(scale * x), exactly.

    Rows are dealt in blocks of about ``block_rows`` by a hash of the id and every block meets the stated
    queries: means and deviations of 1, 2, 4 ... segments bound the scores from above (the distances
    from below), the seeds' exact scores set each query's floor, finer segments drop pairs below it,
    and survivors are computed exactly (by one product of a block where over a fifth of its pairs survive, which
    is cheaper than a product a pair). Blocks' best are merged a query at a time.

    Rows whose vector is null, of another dimension, or holds null or non-finite components take no part.
    Zero vectors do. Rows that repeat an id each count; ties go to the smaller id. Other columns aren't
    read. Empty tables give no rows.
    """
    rows, d, n = usable_vectors(frame, id_col, vec_col, False)
    asked = queries.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = asked.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") == d) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    blocks = max(1, -(-n // block_rows))
    whole = lambda f: f.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    own = whole(rows).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    sent = whole(asked).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def best(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asked):
            own = own.sort_values("vec_id")
            x, ids = _stacked(own["v"], d), own["vec_id"].to_numpy()
            q_all, q_ids = _stacked(asked["v"], d), asked["vec_id"].to_numpy()
            for first in range(0, len(q_all), 256):
                qi = q_ids[first : first + 256]
                found += zip(qi, top_by_bounds(q_all[first : first + 256], qi, x, ids, k), strict=True)
        return pd.DataFrame([(int(i), h) for i, h in found], columns=["query_id", "hits"])

    hits = own.groupBy("block").cogroup(sent.groupBy("block")).applyInPandas(best, f"query_id long, hits {_WHOLE_HITS}")
    return _merged(hits, k, "long")


def op3_topk(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return search_exact(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


OP3_SQL = """
with v as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as w from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([q.w[i] * c.w[i] for i in range(1, len(q.w) + 1)]) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
