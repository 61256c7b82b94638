"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

Words are lower-cased and padded with a space at each side; their character
n-grams (N_MIN to N_MAX characters) are counted per text and hashed to BUCKETS.
A feature is "the gram stands in at least so many of a thousand words"
(LEVELS; the first level is any occurrence), so that a gram that other texts
have by chance tells less than one that fills a text.

1. the classifier learns from about LABELLED_IDS labelled ids, chosen by a hash of
   the id (all of them if there are no more): a bound for the broadcast that finds
   their texts, which are therefore never shuffled.  Every task counts in how many
   of these texts of each class a feature is set; the sums give its log-count ratio
       r = log((c1 + s P1) / (c0 + s P0)) - log(N1 / N0),
   where P1, P0 are the shares of the classes: the prior of weight s pulls a rare
   feature to no opinion, whatever the balance of the classes.  Features with
   abs(r) below LEAST_RATIO are left out;
2. a logistic regression over the values r of a text's features is fitted by
   AdaGrad, its weights drawn to one common weight.  It is fitted on the driver on
   about FIT_ROWS of the labelled rows, chosen likewise, each a handful of numbers;
3. every text is scored by a broadcast table of the kept features: BUCKETS times
   the levels at most, whatever the size of the corpus.

Defined cases: a null text is empty, and an empty text has no feature: its score
is that of the intercept; a null id is never labelled and not held out; a null
label is no label; of rows with one id any label 1 makes it 1; without rows of
both classes every score is the share of the one there is (0 without any);
repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import ship, stored

N_MIN, N_MAX = 2, 6
BUCKETS = 1 << 21
#: Least share of a text's words in which a gram has to stand, per level; 0: once.
LEVELS = (0.0, 1 / 128, 1 / 64)
SMOOTHING = 20.0
LEAST_RATIO = 1.5
#: Labelled ids that are learnt from, and labelled rows that the regression is fitted on, about (twice that at most).
LABELLED_IDS = 200_000
FIT_ROWS = 40_000
EPOCHS, STEP, DECAY, COMMON = 10, 0.1, 1e-3, 0.3
THRESHOLD = 0.7
HELD_OUT_OF, HELD_OUT = 3, 1
#: Different words whose grams a task holds, and features of a block of counters.
HELD_WORDS = 300_000
BLOCK = 1 << 16

_PRIME = np.uint64(0x9E3779B97F4A7C15)


class WordGrams:
    """The hashed n-grams of words, worked out for all new words of a batch at once."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted, self.of = wanted, {}

    def learn(self, words: set[str]) -> None:
        if len(self.of) > HELD_WORDS:
            self.of = {}
        new = [w for w in words if w not in self.of]
        if not new:
            return
        chars = np.frombuffer((" " + " ".join(new) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        space = chars == 32
        word_of = np.cumsum(space) - 1                    # of a place inside a word
        hashes, owners = [], []
        rolled = np.zeros(len(chars), np.uint64)
        inner = np.cumsum(np.r_[0, space])                # spaces before a place
        for n in range(1, N_MAX + 1):
            size = len(chars) - n + 1
            if size <= 0:
                break
            rolled = rolled[:size] * _PRIME + chars[n - 1:].astype(np.uint64) + np.uint64(1)
            if n < N_MIN:
                continue
            at = np.flatnonzero(inner[n - 1:n - 1 + size] == inner[1:1 + size])     # no space between its ends
            x = rolled[at] ^ rolled[at] >> np.uint64(29)
            x = x * np.uint64(0xD6E8FEB86659FD93)
            hashes.append((x >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64))
            owners.append(word_of[at + np.where(space[at], 1, 0)])
        # A gram of two characters may be "x " or " x": its word is that of the character.
        hashed, owner = np.concatenate(hashes), np.concatenate(owners)
        if self.wanted is not None:
            keep = self.wanted[hashed]
            hashed, owner = hashed[keep], owner[keep]
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(new) + 1))
        hashed = hashed[order]
        none = hashed[:0]
        for i, w in enumerate(new):
            lo, hi = ends[i], ends[i + 1]
            self.of[w] = hashed[lo:hi].copy() if hi > lo else none

    def features(self, counts: Counter) -> np.ndarray:
        """The features that are set in a text of these words: gram times levels, plus the level."""
        some = [(g, n) for w, n in counts.items() if len(g := self.of[w])]
        if not some:
            return np.zeros(0, np.int64)
        grams = np.concatenate([g for g, _ in some])
        times = np.repeat(np.array([n for _, n in some]), [len(g) for g, _ in some])
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        total, grams = np.add.reduceat(times[order], first), grams[first]
        size = sum(counts.values())
        return np.concatenate([grams[total >= share * size] * len(LEVELS) + level for level, share in enumerate(LEVELS)])


def _texts(batch: pa.RecordBatch, column: int, grams: WordGrams) -> Iterator[np.ndarray]:
    """The features of the texts of a batch."""
    counted, new = [], set()
    for value in batch.column(column).cast(pa.binary()):
        counts = Counter((value.as_py() or b"").decode("utf-8", "replace").lower().split())
        counted.append(counts)
        new.update(counts)
        if len(new) > HELD_WORDS // 4:
            grams.learn(new)
            yield from map(grams.features, counted)
            counted, new = [], set()
    grams.learn(new)
    yield from map(grams.features, counted)


@dataclass
class Model:
    """The weight of every kept feature (weight times log-count ratio) and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float


def _about(df: DataFrame, h: Column, total: int, wanted: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, those with a small hash ``h``; all if there are no more."""
    return df if total <= wanted else df.where(F.pmod(h, F.lit(1_000_000)) < int(1_000_000 * wanted / total))


def _label_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    """(id, text, label) of the labelled training rows."""
    marked = stored(labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").alias("id"), "toxic").where(train)
                    .groupBy("id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("label")), "toxic-labels")
    some = _about(marked, F.xxhash64("id"), marked.count(), LABELLED_IDS).limit(2 * LABELLED_IDS)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.join(F.broadcast(some), "id").select("id", "text", "label")


def class_counts(rows: DataFrame) -> DataFrame:
    """(block, counts): packed numbers of texts without and with label 1 in which each feature of a block is set."""
    size = BUCKETS * len(LEVELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.uint32)
        grams = WordGrams()
        for batch in batches:
            for label, features in zip(batch.column(1).to_pylist(), _texts(batch, 0, grams), strict=True):
                counts[label, features] += 1
        for block in range(0, size, BLOCK):
            part = counts[:, block:block + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([_packed(part)], pa.binary())], ["block", "counts"])

    def add(parts: pa.Table) -> pa.Table:
        total = np.zeros((2, min(BLOCK, size - parts["block"][0].as_py())), np.int64)
        for data in parts["counts"]:
            total += _unpacked(data.as_py(), np.uint32, total.shape)
        at = np.flatnonzero(total.any(axis=0))
        return pa.table({"feature": at + parts["block"][0].as_py(), "zeros": total[0, at], "ones": total[1, at]})

    return (rows.select("text", "label").mapInArrow(run, "block long, counts binary")
            .groupBy("block").applyInArrow(add, "feature long, zeros long, ones long"))


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind, shape) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind).reshape(shape)


def log_count_ratios(counts: DataFrame, zeros: int, ones: int) -> DataFrame:
    """(feature, ratio): the features whose ratio is LEAST_RATIO at least, either way."""
    share = ones / (zeros + ones)
    ratio = F.log((F.col("ones") + SMOOTHING * share) / (F.col("zeros") + SMOOTHING * (1 - share))) - float(np.log(ones / zeros))
    return counts.select("feature", ratio.alias("ratio")).where(F.abs("ratio") >= LEAST_RATIO)


def _lookup(features: np.ndarray) -> np.ndarray:
    """Which grams have a kept feature."""
    wanted = np.zeros(BUCKETS, bool)
    wanted[features // len(LEVELS)] = True
    return wanted


def _places(kept: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Where some features stand among the sorted kept ones, those not kept left out."""
    at = np.searchsorted(kept, features)
    at[at == len(kept)] = 0
    return at[kept[at] == features] if len(kept) else at[:0]


def fit(rows: list[tuple[np.ndarray, int]], ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression over ``ratios`` of each row's features, by AdaGrad."""
    weights, squares = np.full(len(ratios), COMMON), np.full(len(ratios), 1e-6)
    intercept, square = -2.0, 1e-6
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, label = rows[i]
            x, w = ratios[at], weights[at]
            g = 1 / (1 + np.exp(-min(max(float(w @ x) + intercept, -30.0), 30.0))) - label
            step = g * x + DECAY * (w - COMMON)
            squares[at] += step * step
            weights[at] = w - STEP * step / np.sqrt(squares[at])
            square += g * g
            intercept -= STEP * g / np.sqrt(square)
    return weights, float(intercept)


def train(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model learnt from the labelled rows for which ``training``, a condition on the id (column id), holds."""
    spark = docs.sparkSession
    ship(spark)
    rows = _label_rows(docs, labels, id_col, text_col, training)
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    zeros, ones = sizes.get(0, 0), sizes.get(1, 0)
    if not zeros or not ones:
        return Model(np.zeros(0, np.int64), np.zeros(0), 40.0 if ones else -np.inf)
    kept = log_count_ratios(stored(class_counts(rows), "toxic-counts"), zeros, ones).toPandas()   # BUCKETS x levels at most
    order = np.argsort(kept["feature"].to_numpy())
    features, ratios = kept["feature"].to_numpy()[order], kept["ratio"].to_numpy()[order]
    sent = spark.sparkContext.broadcast(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = WordGrams(_lookup(sent.value))
        for batch in batches:
            found = [_places(sent.value, f).astype(np.int32) for f in _texts(batch, 1, grams)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes() for f in found], pa.binary()), batch.column(2)],
                                             ["h", "places", "label"])

    chosen = _about(rows.select(F.xxhash64(F.xxhash64("id"), F.xxhash64("text")).alias("h"), "text", "label"), F.col("h"),
                    zeros + ones, FIT_ROWS)
    drawn = sorted(map(tuple, chosen.mapInArrow(run, "h long, places binary, label int").limit(2 * FIT_ROWS).collect()))
    weights, intercept = fit([(np.frombuffer(p, np.int32), y) for _, p, y in drawn], ratios)
    return Model(features, weights * ratios, intercept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        grams = WordGrams(_lookup(model.features))
        for batch in batches:
            margins = np.array([model.weights[_places(model.features, f)].sum() for f in _texts(batch, 1, grams)]) + model.intercept
            with np.errstate(over="ignore"):                    # far below: 0
                scores = 1 / (1 + np.exp(-margins))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def _remainder(id_col: str) -> Column:
    """crc32 of the id's text (of a null id: of the empty text), modulo HELD_OUT_OF."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF


def op12_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, _remainder("id") != HELD_OUT)
    return score(docs, model).select("doc_id", (_remainder("doc_id") == HELD_OUT).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
