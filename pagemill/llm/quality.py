"""Quality scores from document statistics through random Fourier features.

Statistics of a text are standardised and mapped by random Fourier features, whose inner products
approximate a Gaussian kernel. Ridge weights solve normal equations summed over partitions; isotonic
regression on labelled rows kept aside turns raw scores into shares of good documents.

The fit uses a bounded sample of the labelled rows (``FIT_ROWS``), dealt to ``FIT_PARTS`` tasks, so that
what reaches the driver is bounded too. Statistics cover every whole text and are written once.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, sampled, schema_of, utf8

FIT_ROWS, FIT_PARTS, FEATURES, RIDGE, BINS = 60_000, 12, 256, 1e-3, 1000
SEED = 11

#: Fixed classes of bytes whose shares are statistics.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"()-", b"!?", b"|/\\<>[]{}=+_", b"#$%&*@~^`", bytes(range(128, 256)))
N_STATISTICS = len(CLASSES) + 12
_class = np.zeros((256, len(CLASSES)))
for _i, _chars in enumerate(CLASSES):
    _class[list(_chars), _i] = 1


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one whole text; all zero if it is empty."""
    out = np.zeros(N_STATISTICS)
    if not text:
        return out
    k = len(CLASSES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    out[:k] = counts @ _class / len(text)
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    out[k] = np.log1p(len(text))
    out[k + 1] = np.log1p(n)
    out[k + 2] = np.log1p(len(lines))
    out[k + 3] = len(set(lines)) / len(lines)
    out[k + 4] = np.log1p(max(map(len, lines)))
    if n:
        lengths = np.fromiter(map(len, words), np.int64, n)
        often = Counter(words)
        out[k + 5] = np.log1p(lengths.mean())
        out[k + 6] = lengths.std() / (1 + lengths.mean())
        out[k + 7] = np.log1p(lengths.max())
        out[k + 8] = len(often) / n
        out[k + 9] = max(often.values()) / n
        out[k + 10] = sum(map(eq, words, words[1:])) / n
        out[k + 11] = (counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / n
    return out


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x) with the statistics of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([statistics(t) for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["id", "x"])

    return arrow_map(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")), run, f"id {docs.schema[id_col].dataType.simpleString()}, x array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The non-decreasing means that fit bins of n rows with sums y best (pool adjacent violators)."""
    pools: list[list[float]] = []
    for k, (weight, total) in enumerate(zip(n, y, strict=True)):
        pools.append([weight, total, k + 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w, t, end = pools.pop()
            pools[-1] = [pools[-1][0] + w, pools[-1][1] + t, end]
    out = np.zeros(len(n))
    first = 0
    for w, t, end in pools:
        out[first:end] = t / w if w else 0.0
        first = end
    return out


class Model:
    """Standardisation, Fourier features, ridge weights and the calibrated step function."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.turn = rng.normal(size=(len(mean), FEATURES)) / np.sqrt(len(mean))
        self.shift = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.knots, self.values = np.array([0.0, 1.0]), np.array([0.5, 0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.cos(z @ self.turn + self.shift) * np.sqrt(2 / FEATURES), np.ones(len(z))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, -0.5, 1.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _sums(rows: DataFrame, of, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over partitions of arrays that ``of(x, y)`` gives for batches."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of(matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    parts = rows.mapInArrow(run, schema_of("total binary")).collect()  # FIT_PARTS rows of a fixed size
    return sum((np.frombuffer(p.total).reshape(shape) for p in parts), np.zeros(shape))


def fit(described: DataFrame, labels: DataFrame, label_col: str, aside: Column) -> Model:
    """Fit on rows (id, x) joined with labels (id, label); rows that hold ``aside`` calibrate.

    Of more than ``FIT_ROWS`` labels a sample of about so many is used, chosen by a hash of the id: few enough
    to be broadcast, so the statistics stay where they are. An empty sample of labels is an error; labels
    that meet no document give a model that scores 0.5.
    """
    scratch = Scratch(described.sparkSession, "quality-fit")
    known = labels.where(F.col(label_col).isNotNull()).groupBy("id").agg(F.max(label_col).cast("double").alias("y"))
    n = known.count()
    if n > FIT_ROWS:
        known = known.where(sampled(FIT_ROWS / n, "id"))
        if known.isEmpty():
            raise ValueError("the sample of labels is empty")
    rows = scratch.put(described.join(F.broadcast(known), "id").select("x", "y", aside.alias("aside")).repartition(FIT_PARTS))
    learn, check = rows.where("not aside").select("x", "y"), rows.where("aside").select("x", "y")
    k = N_STATISTICS
    s = _sums(learn, lambda x, y: np.stack([np.full(k, len(x)), x.sum(0), (x * x).sum(0)]), (3, k))
    if not s[0, 0]:
        return Model(np.zeros(k), np.ones(k))
    mean = s[1] / s[0]
    model = Model(mean, np.sqrt(np.maximum(s[2] / s[0] - mean**2, 1e-8)) + 1e-6)

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = model.features(x)
        return np.column_stack([f.T @ f, f.T @ y])

    both = _sums(learn, equations, (FEATURES + 1, FEATURES + 2))
    model.weights = np.linalg.solve(both[:, :-1] + RIDGE * s[0, 0] / FEATURES * np.eye(FEATURES + 1), both[:, -1])

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        b = np.clip(((model.raw(x) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.stack([np.bincount(b, minlength=BINS), np.bincount(b, weights=y, minlength=BINS)])

    bins = _sums(check, binned, (2, BINS))
    full = np.flatnonzero(bins[0])
    if len(full):
        model.knots, model.values = (full + 0.5) / BINS * 2 - 0.5, isotonic(bins[0][full], bins[1][full])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn: Column | None = None, aside: Column | None = None) -> DataFrame:
    """Rows (id, score): how likely label 1 is, for every row of ``docs``.

    ``learn`` chooses, by the id, the labelled rows that may be used, ``aside`` those of them that calibrate.
    Null texts count as empty and are scored too. Labels of unknown ids, null labels and rows repeated in
    ``labels`` (the larger label counts) do no harm; without labels every score is 0.5. Other columns
    are ignored; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    described = scratch.put(describe(docs, id_col, text_col))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    model = fit(described, known.where(F.lit(True) if learn is None else learn), "label", F.pmod(F.xxhash64("id"), F.lit(4)) == 0 if aside is None else aside)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(matrix(batch.column(1))))], ["id", "score"])

    return arrow_map(described, run, f"id {docs.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
