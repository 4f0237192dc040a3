"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network on top."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bounded, slices

#: Words share this many vectors (by hash), of this many dimensions; their table has one size on any corpus.
WORDS, DIMS = 1 << 15, 32
#: Non-zero entries of a word's index vector, and words to either side that add theirs to its context vector.
ENTRIES, REACH = 2, 2
#: Words, and every mark by itself.
TOKEN = r"\w+|[^\w\s]"
#: Tokens pooled at a time.
CHUNK = 1 << 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every index vector."""
    random = np.random.default_rng(11)
    return random.integers(0, DIMS, (WORDS, ENTRIES)), random.choice([-1.0, 1.0], (WORDS, ENTRIES))


def _token_ids():
    find = re.compile(TOKEN).findall
    ids = Bounded(lambda word: zlib.crc32(word.encode("utf-8", "surrogatepass")) & (WORDS - 1))
    return lambda text: np.fromiter(map(ids.__getitem__, found := find(text or "")), np.int64, len(found))


def _contexts(schema: pa.Schema):
    """Sums of the neighbours' index vectors and counts per word, one row per word and partition."""

    def run(batches):
        ids_of, (place, sign) = _token_ids(), _index_vectors()
        sums, counts = np.zeros(WORDS * DIMS), np.zeros(WORDS)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                lists = [ids_of(text) for text in part["text"].to_pylist()]
                ids = np.concatenate(lists)
                doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                counts += np.bincount(ids, minlength=WORDS)
                for step in range(1, REACH + 1):
                    near = doc[step:] == doc[:-step]
                    a, b = ids[:-step][near], ids[step:][near]
                    for own, other in ((a, b), (b, a)):
                        for entry in range(ENTRIES):
                            at = own * DIMS + place[other, entry]
                            sums += np.bincount(at, weights=sign[other, entry], minlength=WORDS * DIMS)
        used = np.flatnonzero(counts)
        columns = sums.reshape(WORDS, DIMS)[used].astype(np.int64)
        arrays = [pa.array(used), pa.array(counts[used].astype(np.int64)), *[pa.array(c) for c in columns.T]]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def word_vectors(df: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit context vectors and weights a / (a + frequency) of all words, from every row of ``df``."""
    names = ["word", "n", *[f"c{i}" for i in range(DIMS)]]
    schema = pa.schema([pa.field(c, pa.int64()) for c in names])
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    parts = texts.mapInArrow(_contexts(schema), ", ".join(f"{c} long" for c in names))
    rows = np.array(parts.groupBy("word").agg(*[F.sum(c) for c in names[1:]]).collect(), np.float64).reshape(-1, DIMS + 2)
    vectors, weights = np.zeros((WORDS, DIMS), np.float32), np.ones(WORDS, np.float32)
    at = rows[:, 0].astype(np.int64)
    length = np.linalg.norm(rows[:, 2:], axis=1, keepdims=True)
    vectors[at] = rows[:, 2:] / np.where(length > 0, length, 1)
    share = rows[:, 1] / max(1.0, rows[:, 1].sum())
    weights[at] = 1e-3 / (1e-3 + share)
    return vectors, weights


def pooled(ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted mean and deviation of the word vectors, length, and share of different words."""
    total, first, second = 1e-9, np.zeros(DIMS), np.zeros(DIMS)
    for begin in range(0, len(ids), CHUNK):
        part = ids[begin : begin + CHUNK]
        w, v = weights[part], vectors[part]
        total += float(w.sum(dtype=np.float64))
        first += (w @ v).astype(np.float64)
        second += (w @ (v * v)).astype(np.float64)
    mean = first / total
    spread = np.sqrt(np.maximum(second / total - mean * mean, 0))
    different = len(np.unique(ids)) / max(1, len(ids))
    return np.concatenate([mean, spread, [np.log1p(len(ids)), different]])


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` makes its probabilities calibrated."""

    shift: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.hidden + self.bias) @ self.out + self.out_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, units: int = 32, steps: int = 600, batch: int = 512) -> Network:
    """Fit on four fifths of the rows by Adam; the temperature is the one with the least loss on the others."""
    random = np.random.default_rng(5)
    order = random.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    scale = x[used].std(axis=0)
    model = Network(
        x[used].mean(axis=0),
        np.where(scale > 1e-9, scale, 1),
        random.standard_normal((x.shape[1], units)) / np.sqrt(x.shape[1]),
        np.zeros(units),
        random.standard_normal(units) / np.sqrt(units),
        0.0,
    )
    z = (x - model.shift) / model.scale
    names = ("hidden", "bias", "out", "out_bias")
    first, second = {n: 0.0 for n in names}, {n: 0.0 for n in names}
    for step in range(1, steps + 1):
        pick = random.choice(used, min(batch, len(used)), replace=False)
        active = np.tanh(z[pick] @ model.hidden + model.bias)
        error = (1 / (1 + np.exp(-np.clip(active @ model.out + model.out_bias, -60, 60))) - y[pick]) / len(pick)
        back = error[:, None] * model.out * (1 - active * active)
        slopes = {
            "hidden": z[pick].T @ back + 1e-4 * model.hidden,
            "bias": back.sum(axis=0),
            "out": active.T @ error + 1e-4 * model.out,
            "out_bias": error.sum(),
        }
        for n in names:
            first[n] = 0.9 * first[n] + 0.1 * slopes[n]
            second[n] = 0.999 * second[n] + 0.001 * slopes[n] ** 2
            move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
            setattr(model, n, getattr(model, n) - 0.02 * move)
    if len(held):
        logits, truth = model.logits(x[held]), 2 * y[held] - 1
        losses = [(np.logaddexp(0, -truth * logits / t).mean(), t) for t in np.geomspace(0.25, 8, 41)]
        model.temperature = float(min(losses)[1])
    return model


@dataclass
class QualityModel:
    vectors: np.ndarray
    weights: np.ndarray
    network: Network | None

    def features(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """All columns but the text, and ``features``."""
        vectors, weights = self.vectors, self.weights

        def run(batches):
            ids_of = _token_ids()
            for batch in batches:
                for part in slices(batch, "text"):
                    rows = [pooled(ids_of(text), vectors, weights) for text in part["text"].to_pylist()]
                    lists = pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([part["row"], lists], ["row", "features"])

        return _with_row(df, text_col, run, "features array<double>", keep_text=False)

    def score(self, df: DataFrame, text_col: str = "text", threshold: float = 0.3, keep_text: bool = True) -> DataFrame:
        """All columns (the text only with ``keep_text``) plus ``score`` and ``predicted``."""
        vectors, weights, network = self.vectors, self.weights, self.network

        def run(batches):
            ids_of = _token_ids()
            for batch in batches:
                for part in slices(batch, "text"):
                    x = np.array([pooled(ids_of(text), vectors, weights) for text in part["text"].to_pylist()])
                    score = network.probabilities(x) if network else np.full(len(x), 0.5)
                    columns = [part["row"], *([part["text"]] if keep_text else []), pa.array(score)]
                    names = ["row", *(["text"] if keep_text else []), "score"]
                    yield pa.RecordBatch.from_arrays(columns, names)

        out = _with_row(df, text_col, run, "score double", keep_text)
        return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def _with_row(df: DataFrame, text_col: str, run, added: str, keep_text: bool) -> DataFrame:
    rest = [c for c in df.columns if c != text_col and c not in ("score", "predicted", "features")]
    fields = [F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_")]
    rows = df.select(F.struct(*fields).alias("row"), F.col(text_col).cast("string").alias("text"))
    text = "text string, " if keep_text else ""
    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {text}{added}")
    own = [F.col("row")[c].alias(c) for c in rest]
    return out.select(*own, *([F.col("text").alias(text_col)] if keep_text else []), added.split()[0])


def held_out(id_col: str) -> F.Column:
    """Rows that labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = 20_000,
) -> QualityModel:
    """Word vectors from all texts; the network from at most ``sample`` labelled rows (those of smallest id hash).

    Every word's index vector is a few random signs. A word's vector is the sum of the index vectors of the words
    around it, over the corpus; words are hashed into a table of fixed size, so that it may travel with the tasks. A
    document's features are the frequency-weighted mean and deviation of its word vectors, its length and the share of
    different words; no other column is looked at. The network is trained on the driver, on the bounded sample.

    Null texts count as empty. Rows with a null id, label or text label nothing; an id labelled twice has the larger
    label; of repeated ids one row is used. Without labels every score is 0.5.
    """
    vectors, weights = word_vectors(df, text_col)
    model = QualityModel(vectors, weights, None)
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_y")).dropna()
    known = known.where(~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).dropna()
    texts = texts.join(F.broadcast(known), "_id")
    rows = model.features(texts).dropDuplicates(["_id"]).collect()
    rows.sort(key=lambda r: r["_id"])
    y = np.array([r["_y"] for r in rows])
    if len(set(y.tolist())) > 1:
        model.network = train(np.array([r["features"] for r in rows]), y)
    return model
