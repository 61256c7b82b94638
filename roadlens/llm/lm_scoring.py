"""Language-model scores by a weighted backoff automaton, built block by block.

The model is a smoothed bigram model.  With c the counts of the training
tokens, N all of them and V the distinct ones,

    p(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w | h) = (c(h w) + K p(w)) / (c(h) + K)

(a Dirichlet prior of weight K on the word probabilities; it sums to one).  As
an automaton: a state per word h; an arc to w for every bigram h w that occurs
in training, with its log-probability; and one failure arc from h to the root,
whose weight is log K / (c(h) + K).  The root has an arc for every word.  A text
is read from left to right once: the state is carried, its arc is taken if there
is one, and else the failure arc, then the root's.

The whole automaton grows with the corpus and is never in one place.  Texts are
cut into blocks of bounded bytes, and each block gets the part of the automaton
that its own bigrams need:

1. every block is written down once as numbers: its words' hashes and its texts
   as rows of local word numbers;
2. a block's distinct words and bigrams, with their training counts inside the
   block, go to buckets by their hash.  A bucket sums over blocks and answers
   each block, in the order in which it asked;
3. a block and its answers meet, and its texts are read.

A very frequent word or bigram is one entry per block, wherever it occurs.
Words are told apart by their 64-bit XXH64.

Defined cases: a null text is an empty one, which has its end token; without any
training token every probability is one; an empty table gives an empty result;
repeated rows are counted and scored each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import free_shuffles, ship, stored

#: Text bytes of a block at most (a longer text is a block of its own), and entries of a bucket on average.
BLOCK_BYTES = 16 << 20
BUCKET_ENTRIES = 1_500_000
#: K: the weight of the word probabilities, in tokens.
PRIOR = 20.0
ADDED = 0.1
#: Tokens read from left to right in one go.
STRETCH = 1024
HELD_OUT = 10                    # a document is held out if this divides the CRC of its id
END = b""                        # no word is empty


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte by byte: the high bytes hardly vary."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def held_out(ids: list) -> np.ndarray:
    """Whether the CRC-32 of each id's text is a multiple of HELD_OUT (a null id's text is empty)."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % HELD_OUT == 0 for i in ids], bool)


def blocks_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per block: its documents' ids, and packed, their token counts and tokens; and the words' hashes.

    Tokens are numbers of the block's words, as they come; the end token is number 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, sizes, tokens, size, numbers = [], [], [], 0, _Numbers({END: 0})

        def block():
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
            counts = np.array(sizes, np.int64)
            train = int(counts[~held_out(ids)].sum())
            row = [(part << 32) + made, train, int(counts.sum())]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in row]
                + [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa_kind))]
                + [pa.array([x], pa.binary()) for x in (packed(counts), packed(np.concatenate(tokens)), hashes.tobytes())],
                ["block", "train", "tokens", "ids", "sizes", "words", "hashes"])

        for batch in batches:
            pa_kind = batch.column(0).type
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                text = value.as_py() or b""
                if ids and size + len(text) > BLOCK_BYTES:
                    yield block()
                    made, size = made + 1, 0
                    ids, sizes, tokens, numbers = [], [], [], _Numbers({END: 0})
                words = text.lower().split()       # on bytes: A to Z, and the six white-space bytes
                words.append(END)
                ids.append(doc_id)
                sizes.append(len(words))
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                size += len(text)
        if ids:
            yield block()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"block long, train long, tokens long, ids array<{kind}>, sizes binary, words binary, hashes binary")


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a pair of hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def _bigrams(words: np.ndarray, vocabulary: int) -> np.ndarray:
    """The bigram before and at each token as a number; the token before a text is the end of another."""
    before = np.r_[np.uint32(0), words[:-1]]       # every text ends with the end token
    return before.astype(np.int64) * vocabulary + words


def _asked(grams: np.ndarray, hashes: np.ndarray, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For a block's words and for its distinct bigrams: their hashes, and their order by bucket."""
    keys = _mixed(hashes[grams // len(hashes)], hashes[grams % len(hashes)])
    return [(k, np.argsort((k % np.uint64(buckets)).astype(np.uint32), kind="stable")) for k in (hashes, keys)]


def answers(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, level, bucket, counts): the training counts of the words (level 1) and bigrams (2) of every block,
    bucket by bucket; and, with block -1, how many different words a bucket of level 1 has seen in training."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, sizes = unpacked(row["words"]), unpacked(row["sizes"])
                hashes = np.frombuffer(row["hashes"], np.uint64)
                train = np.repeat(~held_out(row["ids"]), sizes)
                seen = _bigrams(words, len(hashes)) * 2 + train       # the last bit: a training token
                seen.sort()
                firsts = np.flatnonzero(np.r_[True, seen[1:] >> 1 != seen[:-1] >> 1])
                grams = seen[firsts] >> 1
                asked = _asked(grams, hashes, buckets)
                counts = [np.bincount(words[train], minlength=len(hashes)), np.add.reduceat(seen & 1, firsts)]
                for level, ((keys, order), count) in enumerate(zip(asked, counts, strict=True), 1):
                    bucket = (keys % np.uint64(buckets))[order]
                    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
                    parts = [order[lo:hi] for lo, hi in zip(cuts, cuts[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["block"]] * len(parts), pa.int64()), pa.array([level] * len(parts), pa.int32()),
                        pa.array(bucket[cuts[:-1]].astype(np.int64)), pa.array([keys[p].tobytes() for p in parts], pa.binary()),
                        pa.array([packed(count[p]) for p in parts], pa.binary())], ["block", "level", "bucket", "keys", "counts"])

    def answer(rows: pa.Table) -> pa.Table:
        asked = [np.frombuffer(k, np.uint64) for k in rows["keys"].to_pylist()]
        keys, back = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.concatenate([unpacked(c) for c in rows["counts"].to_pylist()])
        total = np.bincount(back, weights=counts, minlength=len(keys))     # whole numbers, exact far beyond any count
        ends = np.cumsum([len(a) for a in asked])
        level, bucket = rows["level"][0].as_py(), rows["bucket"][0].as_py()
        replies = [packed(total[b]) for b in np.split(back, ends[:-1])]
        return pa.table({
            "block": pa.array([*rows["block"].to_pylist(), -1], pa.int64()), "level": pa.array([level] * (len(replies) + 1), pa.int32()),
            "bucket": pa.array([bucket] * (len(replies) + 1), pa.int64()), "counts": pa.array([*replies, None], pa.binary()),
            "seen": pa.array([0] * len(replies) + [int((total > 0).sum())], pa.int64())})

    requests = blocks.mapInArrow(ask, "block long, level int, bucket long, keys binary, counts binary")
    return (requests.repartition(4 * buckets, "level", "bucket").groupBy("level", "bucket")
            .applyInArrow(answer, "block long, level int, bucket long, counts binary, seen long"))


class Automaton:
    """The part of the automaton that the texts of a block walk through.

    States are numbered by their words; the root comes last.  The arcs of a state lie side by side, by the word that
    they read, which is also the state that they lead to.  Every state but the root has a failure arc, to the root,
    which reads nothing.  The root has an arc for every word of the block."""

    def __init__(self, count: np.ndarray, grams: np.ndarray, gram_count: np.ndarray, total: int, different: int):
        self.root = self.words = len(count)
        p = (count + ADDED) / (total + ADDED * (different + 1))
        self.known = grams[gram_count > 0]                       # arcs by state and word, ascending; then the root's
        state, word = np.divmod(self.known, self.words)
        inner = np.log10((gram_count[gram_count > 0] + PRIOR * p[word]) / (count[state] + PRIOR))
        self.weight = np.r_[inner, np.log10(p)]
        self.failure = np.log10(PRIOR / (count + PRIOR))

    def arc(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The number of the arc by which each state reads its word, -1 where there is none."""
        wanted = state * self.words + word
        at = np.minimum(np.searchsorted(self.known, wanted), max(len(self.known) - 1, 0))
        has = self.known[at] == wanted if len(self.known) else np.zeros(len(wanted), bool)
        return np.where(state == self.root, len(self.known) + word, np.where(has, at, -1))

    def read(self, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The log-probability of each text, from left to right.

        Texts are read in stretches of STRETCH tokens.  A stretch starts in the state that the token before it leads
        to; before a text that is the end token.  All stretches are read at once, a token of each at a time, the
        longest first, so that those still being read are a prefix."""
        ends, cuts = np.cumsum(sizes), -(-sizes // STRETCH)
        first = np.cumsum(cuts) - cuts
        at = np.repeat(ends - sizes, cuts) + STRETCH * (np.arange(cuts.sum()) - np.repeat(first, cuts))
        length = np.minimum(np.repeat(ends, cuts) - at, STRETCH)
        order = np.argsort(-length, kind="stable")
        at, length = at[order], length[order]
        reading = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        sums, state = np.zeros(len(at)), np.r_[0, words].astype(np.int64)[at]
        for step, n in enumerate(reading.tolist()):
            here, word = state[:n], words[at[:n] + step].astype(np.int64)
            arc = self.arc(here, word)
            stuck = np.flatnonzero(arc < 0)
            sums[stuck] += self.failure[here[stuck]]             # the failure arcs, and on from the root
            here[stuck] = self.root
            arc[stuck] = self.arc(here[stuck], word[stuck])
            sums[:n] += self.weight[arc]
            state[:n] = word
        out = np.empty(len(sums))
        out[order] = sums
        return np.add.reduceat(out, first)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = stored(blocks_of(docs, id_col, text_col), "lm-blocks")
    train, tokens = blocks.agg(F.coalesce(F.sum("train"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    buckets = max(4, -(-tokens // BUCKET_ENTRIES))
    replies = stored(answers(blocks, buckets), "lm-answers")
    free_shuffles(spark)
    different = replies.where("block = -1 and level = 1").agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]

    def read(block: pa.Table, reply: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        words, sizes = unpacked(row["words"]), unpacked(row["sizes"]).astype(np.int64)
        hashes = np.frombuffer(row["hashes"], np.uint64)
        grams = np.unique(_bigrams(words, len(hashes)))
        asked = _asked(grams, hashes, buckets)
        counts = []
        for level, (keys, order) in enumerate(asked, 1):
            parts = sorted((b, c) for lv, b, c in zip(*(reply[n].to_pylist() for n in ("level", "bucket", "counts")), strict=True) if lv == level)
            count = np.empty(len(keys))
            count[order] = np.concatenate([unpacked(c) for _, c in parts])
            counts.append(count)
        automaton = Automaton(counts[0], grams, counts[1], train, different)
        starts = np.cumsum(sizes) - sizes
        known = np.add.reduceat((counts[0] > 0)[words].astype(np.int64), starts)
        ids = block["ids"].chunk(0).values
        return pa.table({
            "id": ids, "held_out": pa.array(held_out(row["ids"])), "n_tokens": pa.array(sizes), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(sizes), train)), "base_score": pa.array(np.add.reduceat(automaton.weight[len(automaton.known):][words], starts)),
            "score": pa.array(automaton.read(words, sizes))})

    parts = max(12, -(-tokens // (BLOCK_BYTES // 12)))
    out = (blocks.repartition(parts, "block").groupBy("block")
           .cogroup(replies.where("block >= 0").repartition(parts, "block").groupBy("block"))
           .applyInArrow(read, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return out.withColumnRenamed("id", id_col)


def op2_query(docs: DataFrame) -> DataFrame:
    return score_texts(docs)


