"""Language identification by prediction by partial matching.

For every language a context tree of bytes up to ``order`` deep holds how often each
byte followed each context. The code length of a byte is that of its longest known
context; a byte not seen there costs an escape, D / (N + D), and goes to the next
shorter context, in the end to a uniform choice of 256 (N occurrences, D different
bytes followed). Statistics are frozen after learning. The language with the shortest
code for the whole text wins.

Trees of all languages share their contexts, so scoring is one table look-up per byte:
the context's node from its last three bytes, then the cost of the byte for every
language at once. The tables are small by construction (``max_contexts`` nodes of the
deepest order, at most 257 byte classes). Beyond that, contexts stay by their largest share
of any one language, so a small language keeps its own.

Learning takes at most about ``fit_documents`` whole documents a language, chosen by a
hash. Defined results: ``und`` with score 0 if the text is null or has no letter, or if
nothing was learned; ties go to the first language in alphabetical order; each row is
judged by itself. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shipping import map_batches
from .tables import with_fields

ORDER = 3
FIT_DOCUMENTS = 3000
MAX_CONTEXTS = 16384
SLICE_BYTES = 1 << 20
SLICE_CONTEXTS = 512


def _gram_counts(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (bytes as a big-endian number) and counts of all stretches of ``length`` bytes."""
    keys = []
    for text in texts:
        if len(text) >= length:
            data = np.frombuffer(text, np.uint8).astype(np.int64)
            key = data[: len(data) - length + 1].copy()
            for i in range(1, length):
                key = key << 8 | data[i : len(data) - length + 1 + i]
            keys.append(np.unique(key, return_counts=True))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every, at = np.unique(np.concatenate([k for k, _ in keys]), return_inverse=True)
    return every, np.bincount(at, np.concatenate([c for _, c in keys])).astype(np.int64)


def _counted(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, length, key, n) of all byte stretches up to ORDER + 1 long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for name in sorted(set(langs)):
                own = [t for t, at in zip(texts, langs) if at == name]
                for length in range(1, ORDER + 2):
                    keys, counts = _gram_counts(own, length)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [name] * len(keys), "length": [length] * len(keys), "key": keys, "n": counts}
                    )

    selected = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    grams = map_batches(selected, run, "lang string, length bigint, key bigint, n bigint")
    return grams.groupBy("lang", "length", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    byte_class: np.ndarray  # of each byte; 0: never seen
    node_of: np.ndarray  # of the classes of the last three bytes
    bits: np.ndarray  # [node * classes + class, language]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits for each text (row) in each language (column)."""
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=starts[1:])
        classes = int(self.byte_class.max()) + 1
        symbols = self.byte_class[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        if not len(symbols):
            return total
        context = np.zeros(len(symbols), np.int64)
        for back in range(1, ORDER + 1):
            before = np.zeros(len(symbols), np.int64)
            before[back:] = symbols[:-back]
            for offset in range(back):
                near = starts[:-1][np.diff(starts) > offset] + offset
                before[near] = 0
            context += before * classes ** (back - 1)
        bits = self.bits[self.node_of[context] * classes + symbols]
        full = np.diff(starts) > 0
        total[full] = np.add.reduceat(bits, starts[:-1][full], axis=0, dtype=np.float64)
        return total


def build_model(rows: pa.Table, max_contexts: int = MAX_CONTEXTS) -> LanguageModel | None:
    """From (lang, length, key, n) of byte stretches. Single precision keeps the tables small."""
    if not rows.num_rows:
        return None
    coded = rows["lang"].combine_chunks().dictionary_encode()
    names = coded.dictionary.to_pylist()
    languages = sorted(names)
    column = np.array([languages.index(name) for name in names])[coded.indices.to_numpy()]
    length_of, key_of, n_of = (rows[name].to_numpy() for name in ("length", "key", "n"))
    by_length = {
        length: np.column_stack([values[length_of == length] for values in (key_of, column, n_of)])
        for length in range(1, ORDER + 2)
    }
    seen = np.unique(by_length[1][:, 0])
    byte_class = np.zeros(256, np.uint16)
    byte_class[seen] = np.arange(1, len(seen) + 1)
    classes = len(seen) + 1

    node_of = np.zeros((classes,) * ORDER, np.int32)  # oldest byte first
    ids: dict[tuple[int, int], int] = {(0, 0): 0}
    known = [len(np.unique(grams[:, 0].astype(np.int64) >> 8)) for grams in by_length.values()]
    chances = np.zeros((sum(min(n, max_contexts) for n in known), classes, len(languages)), np.float32)
    for length in range(1, ORDER + 2):
        grams = by_length[length].astype(np.int64)
        context, symbol = grams[:, 0] >> 8, byte_class[grams[:, 0] & 255]
        every, at = np.unique(context, return_inverse=True)
        if len(every) > max_contexts:
            own = np.zeros((len(every), len(languages)))
            np.add.at(own, (at, grams[:, 1]), grams[:, 2])
            weight = (own / np.maximum(own.sum(axis=0), 1)).max(axis=1)
            kept = np.sort(np.lexsort((every, -weight))[:max_contexts])
            place = np.full(len(every), -1)
            place[kept] = np.arange(len(kept))
            every, at, mine = every[kept], place[at], place[at] >= 0
            at, symbol, grams = at[mine], symbol[mine], grams[mine]
        base = len(ids) if length > 1 else 0
        chances[base + at, symbol, grams[:, 1]] = grams[:, 2]
        parents = []
        if length > 1:
            # The next shorter context may have been cut off by max_contexts; then one shorter still.
            for key in every.tolist():
                size = length - 2
                while (size, key & ((1 << 8 * size) - 1)) not in ids:
                    size -= 1
                parents.append(ids[size, key & ((1 << 8 * size) - 1)])
            for i, key in enumerate(every.tolist()):
                ids[length - 1, key] = base + i
                path = [byte_class[key >> 8 * j & 255] for j in range(length - 2, -1, -1)]
                node_of[(Ellipsis, *path)] = base + i
        # In place and slice by slice: the table is the largest thing the driver holds.
        for low in range(0, len(every), SLICE_CONTEXTS):
            high = min(low + SLICE_CONTEXTS, len(every))
            counts = chances[base + low : base + high]
            shorter = chances[parents[low:high]] if parents else np.float32(1 / 256)
            total, different = (x.sum(axis=1, keepdims=True, dtype=np.float32) for x in (counts, counts > 0))
            unseen = counts == 0
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, different / (total + different), np.float32(1))
                np.divide(counts, total + different, out=counts)
            np.multiply(escape, shorter, out=counts, where=unseen)
    np.negative(np.log2(chances, out=chances), out=chances)
    return LanguageModel(languages, byte_class, node_of.ravel(), chances.reshape(-1, len(languages)))


def learn(
    docs: DataFrame,
    where: Column,
    text: str = "text",
    lang: str = "lang",
    fit_documents: int = FIT_DOCUMENTS,
    max_contexts: int = MAX_CONTEXTS,
) -> LanguageModel | None:
    """Trees of the languages of the rows where ``where`` holds; None without such rows."""
    known = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {row[lang]: row["count"] for row in known.groupBy(lang).count().collect()}
    if not counts:
        return None
    chosen = F.lit(False)
    draw = F.pmod(F.xxhash64(text, F.lit(11)), F.lit(1 << 30))
    for name, count in counts.items():
        share = min(1 << 30, int(fit_documents / count * (1 << 30)))
        chosen = chosen | ((F.col(lang) == name) & (draw < share))
    grams = _counted(known.where(chosen), text, lang)
    # One row for each byte stretch of the bounded sample; contexts beyond the limit never leave the executors.
    deepest = grams.where(F.col("length") == ORDER + 1)
    context = F.shiftright("key", 8)
    own = deepest.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("n"))
    totals = own.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = own.join(F.broadcast(totals), "lang").select("context", (F.col("n") / F.col("total")).alias("share"))
    kept = shares.groupBy("context").agg(F.max("share").alias("weight"))
    kept = kept.orderBy(F.desc("weight"), "context").limit(max_contexts).select("context")
    deepest = deepest.join(F.broadcast(kept), context == F.col("context"), "left_semi")
    rows = grams.where(F.col("length") <= ORDER).unionByName(deepest)
    return build_model(rows.toArrow(), max_contexts)


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (share of the winner) and ``bits_per_byte``."""
    schema = with_fields(docs.select(*keep).schema, "lang_pred string, score double, bits_per_byte double")
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    given = docs.select(*keep, F.when(letters, F.col(text)).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column("_text").to_pylist()]
            names, scores, rates = [], [], []
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_BYTES):
                    size += len(texts[end])
                    end += 1
                lengths = model.code_lengths(texts[at:end]) if model else None
                for i, own in enumerate(texts[at:end]):
                    if model is None or not own:
                        names.append("und"), scores.append(0.0), rates.append(None)
                        continue
                    best = int(lengths[i].argmin())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp2(lengths[i][best] - lengths[i]).sum()))
                    rates.append(float(lengths[i][best] / len(own)))
                at = end
            added = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], schema.names)

    return map_batches(given, run, schema)
