"""Token files: ids in canonical, length-limited Huffman code.

The code lengths come from the global counts of the ids (a row per id of the
vocabulary, so bounded), limited by package-merge so that one table decodes
every symbol.  Codes are canonical: the lengths are all that a reader needs.

A file holds the documents of a range of ids, in ascending order, as a row of
independent blocks.  A block has its documents' ids and token counts, the bit
stream, and checkpoints: the bit at which every STRIDE-th token of a document
starts.  The decoder takes one step of the table in all stretches between
checkpoints at once.  Blocks are rows of Parquet, so any store that Spark can
write and read will do.

Steps: texts are encoded once and their ids kept in the shared folder; a second
pass over those ids counts, a third writes the bits of every document, and only
these bits are shuffled into the order of the files.

Defined cases: a null text is an empty one, which still has its end id; an
empty table gives an empty result; repeated rows are written each; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import discard, ship, stored
from roadlens.llm.token_ids import VOCABULARY, loaded, with_end

END_ID = 2
STRIDE = 256
MAX_BITS = 18
#: Tokens from which a block is closed, and tokens of a file on average.
BLOCK_TOKENS = 1 << 19
FILE_TOKENS = 1 << 23


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code (0: it does not occur): the best code with none above ``max_bits``.

    Package-merge.  Level by level, neighbours are paired to packages and merged
    with the symbols by weight; how many of the lightest entries are used at a
    level then says how many symbols get one more bit there.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols need more than {max_bits} bits")
    by = used[np.argsort(counts[used], kind="stable")]
    weights = counts[by].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weights))
        merged = merged[order]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    need = 2 * len(by) - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:need].sum())
        lengths[by[:symbols]] += 1
        need = 2 * (need - symbols)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols in canonical order and the code of every symbol."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    top = int(lengths.max(initial=1))
    spans = (1 << (top - lengths[order].astype(np.int64)))
    firsts = np.cumsum(spans) - spans
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = (firsts >> (top - lengths[order].astype(np.int64))).astype(np.uint64)
    return order, codes


class Coder:
    """Writes and reads bit streams under one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.order, self.codes = canonical(lengths)
        self.top = int(lengths.max(initial=1))
        spans = 1 << (self.top - self.lengths[self.order])
        entries = self.order.astype(np.uint32) << np.uint32(5) | self.lengths[self.order].astype(np.uint32)
        self.table = np.zeros(1 << self.top, np.uint32)
        self.table[:spans.sum()] = np.repeat(entries, spans)

    def write(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The streams of several documents, whose ids stand one after another: 32-bit words, the words of each
        document, and the bit within its document at which each id starts.  No document may be empty."""
        bits = self.lengths[ids]
        ends = np.cumsum(bits)
        doc_ends = np.cumsum(sizes)
        doc_bits = np.diff(np.r_[0, ends[doc_ends - 1]])
        words = (doc_bits + 31) // 32
        within = ends - bits - np.repeat(np.r_[0, ends[doc_ends[:-1] - 1]], sizes)
        at = within + np.repeat((np.cumsum(words) - words) * 32, sizes)
        word = at >> 5
        # A code lies in at most two words; codes do not overlap, so adding them sets the bits.
        value = self.codes[ids] << (64 - (at & 31) - bits).astype(np.uint64)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out = np.zeros(int(words.sum()) + 1, np.uint64)
        out[word[starts]] = np.add.reduceat(value >> np.uint64(32), starts)
        out[word[starts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), starts)
        return out[:-1].astype(">u4"), words, within

    def read(self, stream: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of stretches that begin at bits ``starts`` of the stream and have ``sizes`` ids (at most STRIDE)."""
        raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        # The longest first: the stretches still open are then a prefix.
        order = np.argsort(-sizes, kind="stable")
        at, sizes = starts[order].astype(np.int64), sizes[order]
        out = np.zeros((len(at), int(sizes.max(initial=0))), np.uint32)
        still_open = np.searchsorted(-sizes, -np.arange(out.shape[1]), side="left")
        mask = np.uint32((1 << self.top) - 1)
        for step, n in enumerate(still_open):
            here = at[:n]
            peek = window[here >> 3] >> (32 - self.top - (here & 7)).astype(np.uint32) & mask
            entry = self.table[peek]
            here += entry & np.uint32(31)
            out[:n, step] = entry >> np.uint32(5)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out[back][np.arange(out.shape[1]) < sizes[back][:, None]]


def stretches(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For documents of these token counts: the stretches of each, and the tokens of each stretch."""
    per = -(-sizes // STRIDE)
    tokens = np.full(int(per.sum()), STRIDE, np.int64)
    tokens[np.cumsum(per) - 1] = sizes - (per - 1) * STRIDE
    return per, tokens


def encode_texts(docs: DataFrame, end_id: int, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    """(id, n_tokens, ids): the ids of every text and the end id, as packed integers.  The first row of a run of
    texts also has the different ids of the run and how often each occurs, so that counting reads no other column."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(vocabulary)
        for batch in batches:
            at = 0
            for ids, sizes in encoder.batches(v.as_py() or "" for v in batch.column(1)):
                ids, sizes = with_end(ids, sizes, end_id)
                counts = np.bincount(ids)
                seen = np.flatnonzero(counts)
                note = [[x.astype("<i8").tobytes()] + [None] * (len(sizes) - 1) for x in (seen, counts[seen])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sizes)), pa.array(sizes), binaries(ids, sizes), *(pa.array(c, pa.binary()) for c in note)],
                    ["id", "n_tokens", "ids", "seen", "counts"])
                at += len(sizes)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary, seen binary, counts binary")


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs: the runs' counts, summed per task, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for seen, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(seen, "<i8")
                if len(ids) and ids[-1] >= len(total):
                    total = np.r_[total, np.zeros(int(ids[-1]) + 1 - len(total), np.int64)]
                total[ids] += np.frombuffer(counts, "<i8")
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["token", "n"])

    rows = (encoded.select("seen", "counts").where("seen is not null").mapInArrow(run, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(max((r["token"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:                                               # a row per id of the vocabulary at most
        out[r["token"]] = r["n"]
    return out


BLOCK_FIELDS = "file int, block int, first long, n_tokens long, ids array<{kind}>, tokens binary, checkpoints binary, stream binary"


def write_files(encoded: DataFrame, lengths: np.ndarray, vocabulary: str, total: int) -> DataFrame:
    """Writes the files; returns their blocks as read back.  The encoded ids are deleted."""
    spark = encoded.sparkSession
    kind = encoded.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(lengths)               # a byte per id of the vocabulary

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, dtype = Coder(shared.value), loaded(vocabulary).dtype
        for batch in batches:
            for part in _slices(batch, batch.column(1).to_numpy()):
                sizes = part.column(1).to_numpy()
                ids = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype)
                stream, words, within = coder.write(ids, sizes)
                per, _ = stretches(sizes)
                token = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
                marks = within[np.repeat(np.cumsum(sizes) - sizes, per) + token * STRIDE].astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), binaries(marks, per), binaries(stream, words)],
                    ["id", "n_tokens", "checkpoints", "stream"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, first = TaskContext.get().partitionId(), 0, 0
        for part in _blocks(batches):
            sizes = part.column(1).to_numpy()
            streams = part.column(3).to_pylist()
            bytes_before = np.cumsum([0, *map(len, streams)])[:-1]
            per, _ = stretches(sizes)
            marks = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u4").astype(np.int64) + np.repeat(bytes_before * 8, per)
            yield pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                pa.array([int(sizes.sum())], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                pa.array([sizes.astype("<i8").tobytes()], pa.binary()), pa.array([marks.astype("<i8").tobytes()], pa.binary()),
                pa.array([b"".join(streams)], pa.binary())],
                ["file", "block", "first", "n_tokens", "ids", "tokens", "checkpoints", "stream"])
            block, first = block + 1, first + int(sizes.sum())

    # Written, since a range partition samples what it orders: the bits would be made twice.
    streams = stored(encoded.select("id", "n_tokens", "ids").mapInArrow(
        bits, f"id {kind}, n_tokens long, checkpoints binary, stream binary"), "streams")
    discard(encoded)
    ordered = (streams.repartitionByRange(max(8, -(-total // FILE_TOKENS)), "id", "n_tokens")
               .sortWithinPartitions("id", "n_tokens", "stream"))
    files = stored(ordered.mapInArrow(blocks, BLOCK_FIELDS.format(kind=kind)), "token-files")
    discard(streams)
    return files


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A batch in runs of about BLOCK_TOKENS."""
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff(ends // BLOCK_TOKENS)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows, each closed when it has BLOCK_TOKENS tokens."""
    held, tokens = [], 0
    for batch in batches:
        for part in _slices(batch, batch.column(1).to_numpy()):
            held.append(part)
            tokens += int(part.column(1).to_numpy().sum())
            if tokens >= BLOCK_TOKENS:
                yield _joined(held)
                held, tokens = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An array's bytes, cut into binaries of so many values each."""
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])


def read_files(blocks: DataFrame, lengths: np.ndarray, with_ids: bool = False) -> DataFrame:
    """id, file, start_in_file, n_tokens, ids_crc32 (and the ids) of every document, decoded from the blocks."""
    spark = blocks.sparkSession
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    shared = spark.sparkContext.broadcast(lengths)
    names = ["id", "file", "start_in_file", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = np.frombuffer(batch.column(3)[row].as_py(), "<i8")
                starts = np.frombuffer(batch.column(4)[row].as_py(), "<i8")
                ids = coder.read(batch.column(5)[row].as_py(), starts, stretches(sizes)[1]).astype("<u4")
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[e - n:e].data) for n, e in zip(sizes, ends, strict=True)]
                first = batch.column(1)[row].as_py()
                columns = [batch.column(2)[row].values, pa.array(np.full(len(sizes), batch.column(0)[row].as_py(), np.int32)),
                           pa.array(first + ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    return blocks.select("file", "first", "ids", "tokens", "checkpoints", "stream").mapInArrow(
        run, f"id {kind}, file int, start_in_file long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def token_files(docs: DataFrame, end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = False,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files of ``docs`` and reads them back: id, start, n_tokens, ids_crc32 (and the ids)."""
    spark: SparkSession = docs.sparkSession
    ship(spark)
    encoded = stored(encode_texts(docs, end_id, vocabulary, id_col, text_col), "ids")
    counts = id_counts(encoded)
    lengths = code_lengths(counts)
    blocks = write_files(encoded, lengths, vocabulary, int(counts.sum()))
    per_file = blocks.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()    # a row per file
    before, firsts = 0, []
    for r in per_file:
        firsts.append((r["file"], before))
        before += r["n"]
    bases = spark.createDataFrame(firsts, "file int, base long")
    out = read_files(blocks, lengths, with_ids).join(F.broadcast(bases), "file")
    return out.select(F.col("id").alias(id_col), (F.col("base") + F.col("start_in_file")).alias("start"),
                      "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op9_query(docs: DataFrame) -> DataFrame:
    return token_files(docs)
