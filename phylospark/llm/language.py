"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, let_go, read_table, text_chunks

BUCKETS = 8192
UNDETERMINED = "und"


def subwords(text: str) -> np.ndarray:
    """Buckets of all byte 3-grams and 4-grams of the lower-cased text, a space at either end."""
    b = np.frombuffer(f"  {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    three = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    four = three[:-1] * np.uint32(0x27D4EB2F) + b[3:] * np.uint32(0x165667B1)
    both = np.concatenate([three, four ^ (four >> np.uint32(15))])
    both *= np.uint32(0x2C1B3C6D)
    return (both >> np.uint32(19)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """What a prediction needs: an embedding a bucket, output weights and a bias a language."""

    languages: list[str]
    embed: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        at = subwords(text)
        z = (np.bincount(at, minlength=BUCKETS) @ self.embed / len(at) @ self.out + self.bias) / self.temperature
        e = np.exp(z - z.max())
        best = int(e.argmax())
        return self.languages[best], float(min(1.0, e[best] / e.sum()))


def _train(rows: list[tuple[int, np.ndarray, np.ndarray]], n_languages: int, width: int, epochs: int, rate: float, seed: int):
    """Stochastic gradient descent on (language, buckets, shares); embeddings, weights, bias."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / width, (BUCKETS, width)).astype(np.float32)
    out = np.zeros((width, n_languages), np.float32)
    bias = np.zeros(n_languages, np.float32)
    size = 16
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(rows))
        for first in range(0, len(order), size):
            part = [rows[i] for i in order[first : first + size]]
            y = np.array([r[0] for r in part])
            starts = np.cumsum([0, *(len(r[1]) for r in part[:-1])])
            at, share = np.concatenate([r[1] for r in part]), np.concatenate([r[2] for r in part])
            x = np.add.reduceat(embed[at] * share[:, None], starts)
            z = x @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            back = p @ out.T
            out -= step * x.T @ p
            bias -= 0.1 * step * p.sum(0)
            own = np.repeat(np.arange(len(part)), [len(r[1]) for r in part])
            np.subtract.at(embed, at, step * share[:, None] * back[own])
    return embed, out, bias


def fit_language_model(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3000, width: int = 16, epochs: int = 10, rate: float = 0.5, seed: int = 7
) -> LanguageModel:
    """Fit on a bounded sample of labelled rows.

    Of every language an equal share of ``sample_rows`` is drawn by a hash of id and text, and of every language at least one row; the tasks turn
    whole texts into bucket counts, so the driver sees at most ``sample_rows`` sparse vectors of
    ``BUCKETS`` entries. A fifth of them is kept from training: it sets the softmax temperature and
    the score below which a prediction is rejected (half of the least score among right predictions).
    Every language is learned; where there are more than ``sample_rows`` of them, about one row of each is drawn.
    The driver holds their names and counts, and ``width`` weights for each. Ids may be null or repeat; rows equal in id and text share one draw. Rows with null text or language don't take part. No labelled rows: a model that knows no language.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    draw = F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("least")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, width)), np.zeros((width, 0)), np.zeros(0))
    each = max(1, sample_rows // len(languages))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], max(min(1.0, each / r["n"]), r["least"]))])
    sample = rows.where(draw <= F.element_at(share, F.col("lang")))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                at, n = [], []
                for text in texts:
                    found, times = np.unique(subwords(text), return_counts=True)
                    at.append(found.astype(np.int16))
                    n.append(times.astype(np.int32))
                langs = batch.column("lang").slice(first, len(texts))
                usable = pa.array([has_letter(t) for t in texts])
                made = pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(texts)).cast(pa.string()), langs, pa.array([x.tobytes() for x in at], pa.binary()), pa.array([x.tobytes() for x in n], pa.binary())], ["id", "lang", "at", "n"])
                yield made.filter(usable)

    made = sample.mapInArrow(vectors, "id string, lang string, at binary, n binary").orderBy(F.xxhash64("id", F.lit(seed)), "id", "lang").limit(2 * max(sample_rows, len(languages)))
    number = {lang: i for i, lang in enumerate(languages)}
    data = []
    for r in made.toLocalIterator():  # small arrays, so that the driver holds a few dozen MB at most
        n = np.frombuffer(r["n"], np.int32).astype(np.float32)
        data.append((number[r["lang"]], np.array(np.frombuffer(r["at"], np.int16)), n / n.sum()))
    if not data:
        return LanguageModel([], np.zeros((BUCKETS, width)), np.zeros((width, 0)), np.zeros(0))
    kept, train = data[::5] if len(data) >= 50 else data, [x for i, x in enumerate(data) if i % 5 or len(data) < 50]
    embed, out, bias = _train(train, len(languages), width, epochs, rate, seed)
    embed, out = embed.astype(np.float64), out.astype(np.float64)
    z = np.array([s @ embed[a] @ out + bias for _, a, s in kept])
    y = np.array([k for k, _, _ in kept])

    def shares(temperature: float) -> np.ndarray:
        p = np.exp((z - z.max(1, keepdims=True)) / temperature)
        return p / p.sum(1, keepdims=True)

    grid = np.geomspace(0.2, 5, 33)
    best = min(grid, key=lambda t: -np.log(shares(t)[np.arange(len(y)), y] + 1e-12).mean())
    p = shares(best)
    right = p.max(1)[p.argmax(1) == y]
    return LanguageModel(languages, embed, out, bias.astype(np.float64), float(best), float(right.min() / 2) if len(right) else 0.0)


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to every row, from its whole text alone.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter; otherwise it is the
    likeliest language of the model and its calibrated probability. ``rejected``: und, or a score under
    the model's threshold. One narrow scan; the model (a few hundred kB) travels with the task.
    Columns of ``docs`` with those three names are replaced; all others are kept. Repeated rows and empty tables
    need no care; very long texts are counted whole.
    """
    base = docs.drop("lang_pred", "score", "rejected")
    names = base.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = [model.predict(v.as_py()) for v in batch.column(names.index(text_col))]
            scores = [s for _, s in found]
            arrays = [pa.array([k for k, _ in found], pa.string()), pa.array(scores, pa.float64()), pa.array([k == UNDETERMINED or s < model.reject_below for k, s in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, "lang_pred", "score", "rejected"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType(list(base.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType())
    return base.mapInArrow(predict, schema)


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 4) == 2)
    model = fit_language_model(docs.where(~F.col("held_out")))
    return identify_language(docs.select("doc_id", "held_out", "text"), model).drop("text")
