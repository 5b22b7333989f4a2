"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text becomes a short vector of statistics (shares of character classes, word
lengths, repetition of words and lines). Random Fourier features
sqrt(2/D) cos(w.x + b) approximate a Gaussian kernel over them. Ridge weights solve
normal equations whose matrices are summed over partitions; a separate part of the
labelled rows gives the non-decreasing map from raw scores to probabilities.

The fit uses at most about ``FIT_ROWS`` labelled rows, chosen by a hash of their ids;
statistics and scores cover every row and every whole text.

Defined results: null and empty texts have all-zero statistics and get a score like
any other. Labels of an id on several rows are averaged, null labels and ids are left
out. Without labels every score is 0.5. Each row is scored by itself. Columns of the
input that clash with the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import lookup_join
from ..operators.staging import stage, stage_lookup
from .hashing import word_names
from .shipping import map_batches
from .tables import free_name, with_fields

FIT_ROWS = 200_000
FIT_TASKS = 16
SLICE_BYTES = 1 << 19

_CLASSES = {
    "upper": [(0x41, 0x5A)],
    "lower": [(0x61, 0x7A)],
    "digit": [(0x30, 0x39)],
    "space": [(0x20, 0x20)],
    "line": [(0x0A, 0x0A)],
    "stop": [(0x2E, 0x2E)],
    "comma": [(0x2C, 0x2C)],
    "shout": [(0x21, 0x21), (0x3F, 0x3F)],
    "symbol": [(0x22, 0x2B), (0x2D, 0x2D), (0x2F, 0x2F), (0x3A, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E)],
    "control": [(0x00, 0x08), (0x0B, 0x1F), (0x7F, 0x7F)],
    "letter_lead": [(0xC3, 0xC3)],
    "other_lead": [(0xC2, 0xC2), (0xC4, 0xF7)],
}
STATISTICS = [
    *_CLASSES,
    "log_bytes",
    "log_words",
    "word_bytes",
    "word_bytes_deviation",
    "distinct_words",
    "top_word",
    "repeats_previous_word",
    "log_line_bytes",
    "distinct_lines",
    "shout_lines",
]


def _class_of_byte() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.uint8)
    for at, spans in enumerate(_CLASSES.values()):
        for low, high in spans:
            table[low : high + 1] = at
    return table


_CLASS_OF_BYTE = _class_of_byte()


def _distinct(names: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different names, and count of the commonest, for each owner."""
    if not len(names):
        return np.zeros(owners), np.zeros(owners)
    order = np.lexsort((names, owner))
    changes = np.r_[True, (np.diff(owner[order]) != 0) | (names[order][1:] != names[order][:-1])]
    first = np.flatnonzero(changes)
    counts, owner_of = np.diff(np.r_[first, len(names)]), owner[order][first]
    most = np.zeros(owners)
    np.maximum.at(most, owner_of, counts)
    return np.bincount(owner_of, minlength=owners).astype(float), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of STATISTICS for each UTF-8 text."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.diff(starts) - 1
    size = np.maximum(sizes, 1).astype(float)
    kinds = _CLASS_OF_BYTE[data]
    columns = []
    for at, name in enumerate(_CLASSES):
        sums = np.r_[0, np.cumsum(kinds == at, dtype=np.int64)]
        count = sums[starts[1:]] - sums[starts[:-1]] - (1 if name == "line" else 0)
        columns.append(count / size)

    first, end, names = word_names(data)
    owner = np.searchsorted(starts, first, side="right") - 1
    n = np.bincount(owner, minlength=len(texts)).astype(float)
    words = np.maximum(n, 1)
    length = (end - first).astype(float)
    mean = np.bincount(owner, length, len(texts)) / words
    square = np.bincount(owner, length * length, len(texts)) / words
    distinct, most = _distinct(names, owner, len(texts))
    again = np.r_[False, (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])] if len(names) else np.zeros(0, bool)
    columns += [
        np.log1p(sizes),
        np.log1p(n),
        mean,
        np.sqrt(np.maximum(square - mean * mean, 0)),
        distinct / words,
        most / words,
        np.bincount(owner, again, len(texts)) / words,
    ]

    breaks = np.flatnonzero(data == 0x0A)
    line_first, line_end = np.r_[0, breaks[:-1] + 1], breaks
    owner = np.searchsorted(starts, line_first, side="right") - 1
    lines = np.maximum(np.bincount(owner, minlength=len(texts)).astype(float), 1)
    sums = np.r_[0, np.cumsum(names.astype(np.uint64), dtype=np.uint64)]
    line_names = sums[np.searchsorted(first, line_end)] - sums[np.searchsorted(first, line_first)]
    upper = np.r_[0, np.cumsum(kinds == 0, dtype=np.int64)]
    lower = np.r_[0, np.cumsum(kinds == 1, dtype=np.int64)]
    shouting = (upper[line_end] - upper[line_first]) > (lower[line_end] - lower[line_first])
    columns += [
        np.log1p(size / lines),
        _distinct(line_names, owner, len(texts))[0] / lines,
        np.bincount(owner, shouting, len(texts)) / lines,
    ]
    return np.column_stack(columns)


def document_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``statistics``, an array of doubles in the order of STATISTICS."""
    kept = docs.select(*keep, docs[text].alias("_text"))
    schema = with_fields(docs.select(*keep).schema, "statistics array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"" if t is None else t for t in batch.column("_text").cast(pa.large_binary()).to_pylist()]
            at, rows = 0, []
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
                    size += len(texts[end])
                    end += 1
                rows.append(statistics(texts[at:end]))
                at = end
            values = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            offsets = np.arange(0, values.size + 1, len(STATISTICS), dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*keep, "statistics"])

    return map_batches(kept, run, schema)


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, values: np.ndarray) -> np.ndarray:
        return fourier_features(values, self.centre, self.spread, self.directions, self.phases)

    def score(self, values: np.ndarray) -> np.ndarray:
        raw = self.features(values) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.levels), 0.0, 1.0)


def fourier_features(values, centre, spread, directions, phases) -> np.ndarray:
    standard = np.clip((values - centre) / spread, -8, 8)
    waves = np.sqrt(2.0 / len(phases)) * np.cos(standard @ directions + phases)
    return np.column_stack([waves, np.ones(len(values))])


def isotonic(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and non-decreasing levels by pooling adjacent violators."""
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []  # level, weight, weighted score
    for s, y, w in zip(scores[order], labels[order], weights[order]):
        pools.append([y, w, s * w])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            y2, w2, s2 = pools.pop()
            y1, w1, s1 = pools[-1]
            pools[-1] = [(y1 * w1 + y2 * w2) / (w1 + w2), w1 + w2, s1 + s2]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] for p in pools])


def _rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = batch.column("statistics").flatten().to_numpy().reshape(-1, len(STATISTICS))
    return values, batch.column("label").to_numpy(zero_copy_only=False), batch.column("part").to_numpy()


def _summed(labelled: DataFrame, parts: tuple[int, ...], partial) -> np.ndarray | None:
    """Sum over partitions of the array that ``partial(values, labels)`` gives for its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            values, labels, part = _rows_of(batch)
            mine = np.isin(part, parts)
            if mine.any():
                more = partial(values[mine], labels[mine])
                total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_pydict({"matrix": [total.tobytes()]})

    # FIT_TASKS matrices at most, each of (waves + 2)^2 doubles.
    found = [np.frombuffer(row.matrix) for row in map_batches(labelled, run, "matrix binary").collect()]
    return sum(found[1:], found[0]) if found else None


def fit(
    described: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str = "quality",
    key: str = "doc_id",
    waves: int = 256,
    gamma: float = 0.02,
    ridge: float = 1e-3,
    fit_rows: int = FIT_ROWS,
    bins: int = 2000,
    seed: int = 7,
) -> QualityModel | None:
    """Learn from the rows of ``described`` (statistics) that have a label and where ``learn`` holds.

    Four fifths of them, by a hash of the id, give the weights, one fifth the
    calibration. None without labels.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias("label")).where(learn)
    count = known.count()
    if count > fit_rows:
        share = int(fit_rows / count * (1 << 30))
        known = known.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < share)
    labelled = described.join(known, key).select(
        "statistics", "label", F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(5)).cast("int").alias("part")
    )
    labelled = labelled.coalesce(FIT_TASKS).persist()
    try:
        size = len(STATISTICS)
        sums = _summed(labelled, (0, 1, 2, 3, 4), lambda x, y: np.r_[len(x), x.sum(0), (x * x).sum(0)])
        if sums is None:
            return None
        centre = sums[1 : 1 + size] / sums[0]
        spread = np.sqrt(np.maximum(sums[1 + size :] / sums[0] - centre * centre, 1e-8))
        random = np.random.default_rng(seed)
        directions = random.normal(scale=np.sqrt(2 * gamma), size=(size, waves))
        phases = random.uniform(0, 2 * np.pi, waves)

        def equations(x, y):
            z = fourier_features(x, centre, spread, directions, phases)
            return np.column_stack([z.T @ z, z.T @ y]).ravel()

        summed = _summed(labelled, (0, 1, 2, 3), equations)
        if summed is None:
            summed = _summed(labelled, (4,), equations)
        system = summed.reshape(waves + 1, waves + 2)
        penalty = ridge * max(system[-1, -2], 1.0) / waves * np.eye(waves + 1)
        weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])

        def histogram(x, y):
            raw = fourier_features(x, centre, spread, directions, phases) @ weights
            at = np.clip(((raw + 0.5) / 2.0 * bins).astype(int), 0, bins - 1)
            return np.concatenate([np.bincount(at, w, bins) for w in (np.ones(len(y)), y, raw)])

        counted = _summed(labelled, (4,), histogram)
        if counted is None:
            counted = _summed(labelled, (0, 1, 2, 3), histogram)
        rows, positive, raw = counted.reshape(3, bins)
        full = rows > 0
        knots, levels = isotonic(raw[full] / rows[full], positive[full] / rows[full], rows[full])
    finally:
        labelled.unpersist()
    return QualityModel(centre, spread, directions, phases, weights, knots, levels)


def score(described: DataFrame, model: QualityModel | None, threshold: float = 0.3) -> DataFrame:
    """``described`` without statistics, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    kept = [name for name in described.columns if name not in ("score", "predicted", "statistics")]
    schema = with_fields(described.select(*kept).schema, "score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("statistics").flatten().to_numpy().reshape(-1, len(STATISTICS))
            scores = np.full(len(values), 0.5) if model is None else model.score(values)
            added = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + added, [*kept, "score", "predicted"])

    return map_batches(described.select(*kept, "statistics"), run, schema)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
    threshold: float = 0.3,
    **settings,
) -> DataFrame:
    """``keep`` columns with ``score`` and ``predicted``. Texts are read once; their statistics are staged."""
    described = stage(document_statistics(docs, text, keep))
    model = fit(described, labels, learn, key=key, **settings)
    return score(described, model, threshold)


def accepted(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    The statistics of a row find their way back to it by a hash of id and text, so rows
    of one id are judged by their own texts.
    """
    name = free_name(docs, "row_hash")
    hashed = docs.withColumn(name, F.xxhash64(key, text))
    scored = classify(hashed, labels, learn, text, key, (key, name), **settings)
    rejected = stage_lookup(scored.where("predicted = 0").select(name).distinct())
    # Texts stay where they are as long as the hashes are few enough to be broadcast.
    return lookup_join(hashed, rejected, name, [name], "left_anti").drop(name)
