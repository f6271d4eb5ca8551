"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the character runs of two to four letters inside its words, word
ends included, each hashed to a bucket.  The mean of their embeddings goes through
one linear layer.  Embeddings and layer are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled rows whose subword counts the executors
work out.  A temperature fitted on rows kept out of the descent calibrates the scores, and
sets the score below which a prediction is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm import common

UNKNOWN = "und"
BUCKETS = 1 << 15
DIMENSION = 16
#: Labelled rows a model is fitted on, at most: those of the smallest row hashes.
FIT_ROWS = 4000
EPOCHS = 4
RATE = 0.5
SEED = 7
#: Share of correct predictions that calibration may reject, and the highest threshold.
REJECTED_SHARE, HIGHEST_THRESHOLD = 0.001, 0.5
_SIZES = (2, 3, 4)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def subwords(text: str) -> np.ndarray:
    """Bucket of every subword of the text; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
    codes = codes[~((codes == 0) & np.concatenate(([False], codes[:-1] == 0)))]
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64)
    out = []
    for n in _SIZES:
        if len(codes) < n:
            break
        runs = np.lib.stride_tricks.sliding_window_view(codes, n)
        inside = (runs[:, 1:-1] != 0).all(axis=1)
        mixed = np.full(len(runs), n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ runs[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        out.append((mixed[inside] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, buckets: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        if weights is None:
            buckets, counts = np.unique(buckets, return_counts=True)
            weights = (counts / counts.sum()).astype(np.float32)
        return weights @ self.embeddings[buckets] @ self.layer + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated score); (`und`, 0) for a text without letters."""
        buckets = subwords(text or "")
        if not len(buckets):
            return UNKNOWN, 0.0
        p = _softmax(self.logits(buckets).astype(np.float64) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Fit on (language, buckets, counts) rows; every fifth row only calibrates."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, DIMENSION), np.float32), np.zeros((DIMENSION, 0)), np.zeros(0))
    rng = np.random.default_rng(SEED)
    model = Model(
        languages,
        (rng.random((BUCKETS, DIMENSION), dtype=np.float32) - 0.5) * np.float32(0.2),
        np.zeros((DIMENSION, len(languages)), np.float32),
        np.zeros(len(languages), np.float32),
    )
    number = {v: i for i, v in enumerate(languages)}
    data = [(number[k], b, (c / c.sum()).astype(np.float32)) for k, b, c in rows if len(b)]
    own = [d for i, d in enumerate(data) if i % 5] or data
    aside = [d for i, d in enumerate(data) if not i % 5] or data
    steps, total = 0, EPOCHS * max(1, len(own))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(own)).tolist():
            y, buckets, weights = own[i]
            rate = np.float32(RATE * (1 - steps / total))
            mean = weights @ model.embeddings[buckets]
            err = _softmax(mean @ model.layer + model.bias).astype(np.float32)
            err[y] -= 1
            back = model.layer @ err
            model.layer -= rate * np.outer(mean, err)
            model.bias -= rate * np.float32(0.1) * err
            # buckets of a row are distinct; the mean's gradient, scaled by the rows' number
            model.embeddings[buckets] -= (rate * np.minimum(weights * len(buckets), 4))[:, None] * back
            steps += 1
    _calibrate(model, aside)
    return model


def _calibrate(model: Model, aside: list) -> None:
    if not aside:
        return
    logits = np.array([model.logits(b, w) for _, b, w in aside], dtype=np.float64)
    truth = np.array([y for y, _, _ in aside])

    def scores(temperature: float) -> np.ndarray:
        x = logits / temperature
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.25, 16, 49)
    losses = [-np.log(np.maximum(scores(t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(losses))])
    p = scores(model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    if len(right):
        model.threshold = float(min(HIGHEST_THRESHOLD, np.quantile(right, REJECTED_SHARE)))


def fit(df: DataFrame, usable: Column, text: str = "text", label: str = "lang", rows: int = FIT_ROWS) -> Model:
    """Train on at most `rows` distinct rows of `df` that are usable and labelled.

    The rows with the smallest hashes of label and text are taken: a fixed sample.
    """
    known = df.where(usable & common.quoted(label).isNotNull() & common.quoted(text).isNotNull())
    known = known.select(F.xxhash64(common.quoted(label), common.quoted(text)).alias("pick"), common.quoted(label).alias("label"), common.quoted(text).alias("text"))
    picks = [r.pick for r in known.select("pick").distinct().orderBy("pick").limit(rows).collect()]
    if not picks:
        return train([])
    chosen = known.where(F.col("pick") <= picks[-1])
    counted = chosen.mapInArrow(_counted, "pick long, label string, buckets binary, counts binary").dropDuplicates(["pick", "label"])
    got = counted.toArrow().sort_by([("pick", "ascending"), ("label", "ascending")])
    return train(list(_trainable(got)))


def _trainable(got: pa.Table):
    """Rows of the fetched table, their subwords as views of its bytes."""
    for batch in got.to_batches():
        for label, buckets, counts in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
            yield label.as_py(), np.frombuffer(buckets.as_buffer(), np.uint16), np.frombuffer(counts.as_buffer(), np.int32)


def _counted(batches):
    """Subword counts as bytes: two bytes per bucket, four per count."""
    for whole in batches:
        for batch in common.sliced(whole, [2]):
            buckets, counts = [], []
            for text in batch.column(2):
                b, c = np.unique(subwords(text.as_py()), return_counts=True)
                buckets.append(b.astype(np.uint16).tobytes())
                counts.append(c.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["pick", "label", "buckets", "counts"])


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with lang_pred, score and rejected.

    A text that is null or has no letter is `und` with score 0 and rejected; so is every text
    if nothing was learned.  Whole texts are read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]

    def make():
        own = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            got = [own.predict(t.as_py()) if own.languages else (UNKNOWN, 0.0) for t in texts]
            rejected = [lang == UNKNOWN or score < own.threshold for lang, score in got]
            return [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array(rejected, pa.bool_())]

        return work

    return common.add_columns(df, [text], fields, make)


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the key as text leaves 2 by 4 (a null key: no)."""
    return F.coalesce(F.crc32(common.quoted(key).cast("string")) % 4 == 2, F.lit(False))


def learnable(key: str = "doc_id") -> Column:
    return common.quoted(key).isNotNull() & ~held_out(key)
