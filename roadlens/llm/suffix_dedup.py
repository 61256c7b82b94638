"""Repeated passages by suffix arrays over shards of candidate strings.

A byte goes if it lies in a string of SPAN bytes that also starts elsewhere.

Which strings can repeat is found first.  Every window of SPAN bytes names an
anchor: the place in it whose GRAM bytes have the least hash, the last one of
equals.  Equal windows name the same place, so they share the anchor's hash.
Windows next to each other mostly name the same anchor; an anchor that occurs
once in the corpus is dropped with its windows.  The rest become strings, one
per anchor: the bytes that its own windows cover.  Each window lies in exactly
one string.

The strings are dealt to shards by their anchor's hash, so equal windows meet.
Equal strings are kept once with their number.  A shard's strings are joined to
one text, its suffix array is built by induced sorting, and its permuted common
prefixes tell which windows agree with another one over SPAN bytes.

Nothing is taken whole: a text that several rows share is one text with a
number; an anchor with more than HOT places (a passage in very many texts) is
not put into a shard, but its windows are told apart by 128-bit hashes, a row
each, and counted by Spark, so one key's rows never meet in one task.

Defined cases: a null text is an empty one; a text shorter than SPAN loses
nothing; an empty table gives an empty result; repeated rows are texts of their
own, so all their bytes go, if there are SPAN of them; other columns are
ignored.  An id may be null or repeated: texts are told apart by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import WORD, discard, free_shuffles, join_by_class, ship, stored
from roadlens.llm.induced_sorting import common_prefixes, suffix_array

SPAN = 400
GRAM = 64
#: Bytes of strings in a shard, on average.
SHARD_BYTES = 6_000_000
#: Places from which an anchor is split by window hashes.
HOT = 20_000
#: Bytes of strings that a task hands over at once.
BATCH_BYTES = 4 << 20
#: Between the strings of a shard; UTF-8 does not use it.
APART = b"\xff"

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Rolling:
    """Polynomial hashes, modulo 2**64, of all windows of one width."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.base)])
                self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.inverse)])

    def windows(self, data: np.ndarray, width: int) -> np.ndarray:
        n = len(data)
        self._grow(n)
        sums = np.cumsum((data + np.uint64(1)) * self.powers[:n], dtype=np.uint64)
        ends = sums[width - 1:].copy()
        ends[1:] -= sums[:n - width]
        x = ends * self.inverses[:n - width + 1]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return x


def anchors(data: np.ndarray, rolling: Rolling, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, first window, last window), in order, for all windows of a text's bytes."""
    n, width = len(data), span - gram + 1
    if n < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = rolling.windows(data.astype(np.uint64), gram)
    low = np.uint64(0xFFFFFFFF)
    # The least key is the least upper half, at the last place of equals.
    keys = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.uint64(2**64 - 1))
    padded[:len(keys)] = keys
    forward = np.minimum.accumulate(padded.reshape(rows, width), axis=1).ravel()
    backward = np.minimum.accumulate(padded.reshape(rows, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - span + 1
    place = (low - (np.minimum(backward[:windows], forward[width - 1:width - 1 + windows]) & low)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return hashes[place[first]], first, np.r_[first[1:], windows] - 1


def _key(text: F.Column) -> F.Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _bytes(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def find_anchors(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(h, key, low, high) for every anchor of every row of (key, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(_BASES[0])
        for batch in batches:
            found, which = [], []
            for row, value in enumerate(batch.column(1)):
                h, low, high = anchors(np.frombuffer(value.as_buffer(), np.uint8), rolling, span, gram)
                found.append((h, low, high))
                which.append(len(h))
            h, low, high = (np.concatenate(x) if found else np.zeros(0, np.uint64) for x in zip(*found, strict=True))
            key = batch.column(0).take(pa.array(np.repeat(np.arange(len(which)), which)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), key, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                ["h", "key", "low", "high"])

    return texts.where(F.length("text") >= span).mapInArrow(run, "h long, key binary, low int, high int")


def shared_anchors(found: DataFrame) -> DataFrame:
    """The anchors whose hash occurs at two different places at least; hot: at more than HOT."""
    place = F.xxhash64("key", "low")
    by_hash = (found.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"))
               .where("a <> b").select("h", "n"))
    kept = join_by_class(found, by_hash, "h", "n", found.count())
    return kept.select("key", "h", "low", "high", (F.col("n") > HOT).alias("hot"))


def repeated_windows(strings: dict[bytes, int], span: int) -> list[np.ndarray]:
    """For each of some different strings: whether each window of it agrees with another window of any of them."""
    text = APART.join(strings)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    sa = suffix_array(np.r_[np.frombuffer(text, np.uint8).astype(np.uint16) + np.uint16(1), np.uint16(0)].astype(np.uint16), 257)
    prior, common = common_prefixes(text, sa)
    far = common >= span
    repeated = far.copy()
    repeated[prior[far]] = True
    starts = np.cumsum(lengths + 1) - lengths - 1
    # Two places of the array agree over a whole window only inside their strings, unless a text has APART in it.
    return [repeated[s:s + n - span + 1] for s, n in zip(starts, lengths, strict=True)]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return edges[::2], edges[1::2] - 1


def shard_spans(candidates: DataFrame, shards: int, span: int) -> DataFrame:
    """(key, low, high): windows of the candidate texts that repeat, from their suffix arrays, shard by shard."""
    names = ["h", "key", "low", "string"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for key, text, places in zip(*(batch.column(i) for i in range(3)), strict=True):
                key, text = key.as_py(), text.as_py()
                for p in places.as_py():
                    if not p["hot"]:
                        out.append((p["h"], key, p["low"], text[p["low"]:p["high"] + span]))
                        size += len(out[-1][3])
                if size > BATCH_BYTES:
                    yield _batch(out, names, kinds)
                    out, size = [], 0
        yield _batch(out, names, kinds)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        which, keys, lows = [], [], []
        for batch in batches:
            which += [numbers.setdefault(s, len(numbers)) for s in batch.column(3).to_pylist()]
            keys += batch.column(1).to_pylist()
            lows += batch.column(2).to_pylist()
        if not which:
            return
        flags = repeated_windows(numbers, span)
        # A row may have been read twice only if its text stands in several rows: then it is the same place.
        places: list[set[tuple[bytes, int]]] = [set() for _ in flags]
        for w, key, low in zip(which, keys, lows, strict=True):
            places[w].add((key, low))
        out: list[tuple[bytes, int, int]] = []
        for flag, at in zip(flags, places, strict=True):
            firsts, lasts = (np.array([0]), np.array([len(flag) - 1])) if len(at) > 1 else _runs(flag)
            out += [(key, low + int(a), low + int(b)) for key, low in at for a, b in zip(firsts, lasts, strict=True)]
        yield _batch(out, ["key", "low", "high"], [pa.binary(), pa.int32(), pa.int32()])

    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    strings = candidates.select("key", "text", "places").mapInArrow(cut, "h long, key binary, low int, string binary")
    return strings.repartition(shards, "h").mapInArrow(shard, "key binary, low int, high int")


def hot_spans(candidates: DataFrame, span: int) -> DataFrame:
    """The same for the windows of hot anchors, told apart by two 64-bit hashes and counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollings = [Rolling(b) for b in _BASES]
        for batch in batches:
            for key, value, places in zip(*(batch.column(i) for i in range(3)), strict=True):
                text = np.frombuffer(value.as_buffer(), np.uint8)
                parts = []
                for p in places.as_py():
                    if p["hot"]:
                        string = text[p["low"]:p["high"] + span].astype(np.uint64)
                        parts.append([r.windows(string, span).view(np.int64) for r in rollings]
                                     + [np.arange(p["low"], p["high"] + 1, dtype=np.int32)])
                a, b, low = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([key.as_py()] * len(a), pa.binary()), pa.array(low)],
                                                 ["a", "b", "key", "low"])

    windows = (candidates.where(F.exists("places", lambda p: p["hot"])).select("key", "text", "places")
               .mapInArrow(run, "a long, b long, key binary, low int"))
    windows = windows.withColumn("w", F.concat(F.hex("a"), F.lit("-"), F.hex("b")))
    place = F.xxhash64("key", "low")
    counts = (windows.groupBy("w").agg(F.min(place).alias("x"), F.max(place).alias("y"), F.count(F.lit(1)).alias("n"))
              .where("x <> y").select("w", "n"))
    return join_by_class(windows, counts, "w", "n", windows.count()).select("key", "low", F.col("low").alias("high"))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text without the union of some byte ranges; the bytes and the runs removed."""
    left, at, removed, runs = [], 0, 0, 0
    for low, high in sorted(spans):
        if runs == 0 or low > at:
            left.append(text[at:low])
            runs += 1
            removed += high - low
        elif high > at:
            removed += high - at
        at = max(at, high)
    left.append(text[at:])
    return b"".join(left), removed, runs


def long_runs(text: bytes, windows: list[tuple[int, int]], span: int, over_words: int) -> list[tuple[int, int]]:
    """Of the runs of windows that follow each other, those over more than ``over_words`` words (with those cut
    through) or at least SPAN bytes.  Passages that only touch have no common window and are judged each."""
    runs: list[list[int]] = []
    for low, high in sorted(windows):
        if runs and low <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return [(a, b) for a, b in runs if b + span - a >= SPAN or len(text[a:b + span].split()) > over_words]


def _searched(docs: DataFrame, span: int, gram: int, id_col: str, text_col: str, over_words: int | None,
              keep_texts: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(id, key, ...) of every document; a row per different text, ``whole`` if all of it goes; (key, spans): the windows
    that repeat; and, with ``keep_texts``, the texts of these keys, stored.  Without it, texts pass from the shuffle
    that brings them to their places straight into strings."""
    if not 0 < gram <= span:
        raise ValueError("the gram has to fit into the span")
    spark = docs.sparkSession
    ship(spark)
    text = _bytes(text_col)
    rows = stored(docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", F.unhex(F.sha2("t", 256)).alias("digest"), F.length("t").cast("long").alias("n_bytes"),
        (F.lit(True) if over_words is None else F.when(F.length("t") >= SPAN, True).otherwise(
            F.size(F.regexp_extract_all(F.col("t").cast("string"), F.lit(f"({WORD})"), F.lit(1))) > over_words)).alias("long"))
        .withColumn("key", F.substring("digest", 1, 16)), "texts")
    classes = rows.groupBy("key").agg(F.min("id").alias("one"), F.count(F.lit(1)).alias("copies"),
                                      F.max("n_bytes").alias("n_bytes"), F.max("digest").alias("digest"), F.max("long").alias("long"))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", _key(F.col("text")).alias("key"), "text")
    found = stored(find_anchors(keyed.select("key", "text"), span, gram), "anchors")
    places = stored(shared_anchors(found).groupBy("key").agg(F.collect_set(F.struct("h", "low", "high", "hot")).alias("places")), "places")
    free_shuffles(spark)
    # A text that stands in several rows is taken from those with its least id: its rows are then not one task's.
    wanted = places.join(classes.select("key", "one", "copies"), "key")
    candidates = (wanted.join(keyed, (wanted["key"] == keyed["key"]) & wanted["one"].eqNullSafe(keyed["id"]))
                  .select(wanted["key"], "copies", "text", "places"))
    discard(found)
    sizes = places.select(F.aggregate("places", F.lit(0).cast("long"), lambda a, p: a + p["high"] - p["low"] + span).alias("n"),
                          F.exists("places", lambda p: p["hot"]).alias("hot")).agg(F.sum("n"), F.max("hot")).first()
    if keep_texts or sizes[1]:          # read more than once
        candidates = stored(candidates, "candidates")
        free_shuffles(spark)
    spans = shard_spans(candidates, max(12, -(-(sizes[0] or 0) // SHARD_BYTES)), span)
    if sizes[1]:
        spans = spans.unionByName(hot_spans(candidates, span))
    spans = stored(spans.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")
    discard(places)
    if not keep_texts:
        discard(candidates)
    free_shuffles(spark)
    classes = classes.withColumn("whole", (F.col("copies") > 1) & (F.col("n_bytes") >= span) & F.col("long"))
    return rows, classes, spans, candidates if keep_texts else None


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    rows, classes, spans, candidates = _searched(docs, span, gram, id_col, text_col, None, keep_texts=True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cut_spans(t, [(s["low"], s["high"] + span) for s in w]) for t, w in
                   zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
                 pa.array([hashlib.sha256(o[0]).hexdigest() for o in out])], ["key", "removed", "runs", "sha"])

    # Rows of one text and one id give the same row here: distinct.
    single = candidates.where("copies = 1").join(spans, "key").select("key", "text", "spans").mapInArrow(
        remove, "key binary, removed long, runs long, sha string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    judged = classes.join(single, "key", "left").select(
        "key", "copies", "n_bytes",
        F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), nothing).otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"))
    out = join_by_class(rows.select("id", "key"), judged, "key", "copies", rows.count())
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str | None = None, over_words: int | None = None) -> DataFrame:
    """The documents, all columns, with what is left of their texts, without bytes of characters that were cut through
    (and, in ``length_col``, its length).  With ``over_words``, repeats shorter than SPAN bytes go only if they have
    more words than that.  A document that was cut and has no word left goes.

    Spans go to the documents, which are shuffled once and cut where they arrive."""
    rows, classes, spans, _ = _searched(docs, span, gram, id_col, text_col, over_words, keep_texts=False)

    @F.arrow_udf("string")
    def left(text: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, found in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            if found is None:
                out.append(None)
                continue
            windows = [(s["low"], s["high"]) for s in found]
            if over_words is not None:
                windows = long_runs(t, windows, span, over_words)
            rest, removed, _ = cut_spans(t, [(low, high + span) for low, high in windows])
            out.append(rest.decode("utf-8", "ignore") if removed else None)
        return pa.array(out, pa.string())

    fate = classes.join(spans, "key", "left").where(F.col("whole") | (F.col("copies") == 1) & F.col("spans").isNotNull()).select(
        "key", "copies", "whole", F.when(~F.col("whole"), F.col("spans")).alias("spans"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(_bytes(text_col)).alias("key"))
    out = join_by_class(row, fate, "key", "copies", rows.count(), "left")
    to_cut = F.when(F.col("spans").isNotNull(), _bytes(f"row.`{text_col}`"))
    out = out.withColumn("cut", left.asNondeterministic()(to_cut, "spans")).withColumn(       # evaluated once a row
        "left", F.when(F.col("whole"), F.lit("")).otherwise(F.col("cut")))
    changed = F.col("left").isNotNull()
    new = {text_col: F.col("left"), **({length_col: F.length("left").cast(docs.schema[length_col].dataType)} if length_col else {})}
    kept = out.where(~changed | F.col("left").rlike(WORD))
    return kept.select(*[(F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns])


def op10_query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
