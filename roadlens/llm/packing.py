"""Packing documents into fixed sequences: shortest pack first, over a histogram.

A document's ids (and an end id) are cut into full sequences and one shorter
piece.  Only the histogram of piece lengths, at most ``size`` numbers, goes to
the driver.  There lengths are placed longest first, each into the pack that is
shortest so far, and whole counts of equal packs move at once: a pack is a
pattern of lengths with a count.  A piece finds its pack by its rank among the
pieces of its length: a pattern takes a range of ranks of each of its lengths,
and these ranges, bounded by ``size`` as well, are joined back by broadcast.

Defined cases: a null text is an empty one, which still has its end id; an
empty table gives an empty result; repeated rows are packed each; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import gapless, ship, stored
from roadlens.llm.token_ids import VOCABULARY, loaded, with_end

SIZE = 1024
END_ID = 0


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = VOCABULARY,
           with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens (and, ``with_ids``, the ids) of every piece of every document."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(vocabulary)
        for batch in batches:
            at = 0
            for ids, sizes in encoder.batches(v.as_py() or "" for v in batch.column(1)):
                ids, sizes = with_end(ids, sizes, end_id)
                flat = ids.astype("<u4")
                per = -(-sizes // size)
                which = np.repeat(np.arange(len(sizes)), per)
                start = (np.arange(len(which)) - np.repeat(np.cumsum(per) - per, per)) * size
                length = np.minimum(sizes[which] - start, size)
                low = np.cumsum(length) - length                 # pieces follow each other as the ids do
                crc = [zlib.crc32(flat[a:a + n].data) for a, n in zip(low.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(at + which)), pa.array(start), pa.array(length),
                           pa.array(crc, pa.int64()), pa.array(sizes[which])]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)
                at += len(sizes)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
                           + (", ids array<int>" if with_ids else ""))


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Packs as (lengths, count): longest lengths first, each into the shortest packs that have room.

    Where none has room, the pieces left of a length are dealt evenly to new packs: as many as all tokens that are
    still to place need beyond the room in open packs, so that a length that most pieces have fills packs by itself.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}     # by the room left
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pack, count):
        room = size - sum(pack)
        if count:
            open_packs.setdefault(room, []).append((pack, count)) if room else done.append((pack, count))

    tokens = sum(length * count for length, count in histogram.items())      # still to place
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                free = sum(r * count for r, packs in open_packs.items() for _, count in packs)
                opened = min(left, max(-(-left // (size // length)), -(-(tokens - free) // size)))
                fit, more = divmod(left, opened)
                put((length,) * fit, opened - more)
                put((length,) * (fit + 1), more)
                tokens -= length * left
                break
            pack, count = open_packs[room].pop()
            taken = min(count, left)
            # As many as fit into each pack go in at once, if there are enough of them.
            fit = min(max(left // count, 1), room // length) if taken == count else 1
            if count > taken:
                open_packs[room].append((pack, count - taken))
            if not open_packs[room]:
                del open_packs[room]
            put(pack + (length,) * fit, taken)
            left -= taken * fit
            tokens -= length * taken * fit
    return done + [p for packs in open_packs.values() for p in packs]


def rank_ranges(packs: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) for every place in every pattern."""
    ranks: dict[int, int] = {}
    first, out = 0, []
    for lengths, count in packs:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            out.append((length, rank, rank + count - 1, first, offset))
            ranks[length] = rank + count
            offset += length
        first += count
    return out


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = VOCABULARY,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id (from 0, without gaps) and its offset there."""
    rows = stored(pieces(docs, size, end_id, vocabulary, with_ids, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}     # `size` rows at most
    ranked = gapless(rows, "length", ["id", "start", "ids_crc32"], "rank", sum(histogram.values()))
    ranges = docs.sparkSession.createDataFrame(
        rank_ranges(patterns(histogram, size)), "length long, low long, high long, first long, offset long")
    placed = ranked.join(F.broadcast(ranges), "length").where("rank between low and high")
    return placed.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset", *(["ids"] if with_ids else []))


def op5_query(docs: DataFrame) -> DataFrame:
    return pack(docs)
