"""Near-duplicates by SimHash fingerprints, found through pigeonhole blocks.

A text's words (A to Z in lower case) give shingles of ``shingle`` words; a bit
of the fingerprint is set if more than half of the shingles' 64-bit hashes have
it.  Equal fingerprints are one class from then on.  A fingerprint is split into
BLOCKS blocks; two that differ in at most ``max_bits`` bits agree on at least
``BLOCKS - max_bits`` blocks, so every choice of so many blocks is a join key,
and members of a key's bucket are verified by their Hamming distance.

A bucket yields at most one link per member: to the least member that it
reaches through verified links inside the bucket.  That keeps every component
whole without listing all pairs.  A bucket of many members is not compared
pairwise: members that agree outside ``max_bits`` of the free bits are within
that distance of each other, so sorting once per choice of those bits finds
every link.  A bucket holds distinct fingerprints that agree on some 38 bits
and is streamed from sorted partitions.

Defined cases: a null text is an empty one; without words the fingerprint is
zero and links like any other; fewer words than a shingle are one shingle; an
empty table gives an empty result; repeated rows each get their row; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlens.llm.common import join_by_class, ship, stored, tasks_for
from roadlens.llm.components import components

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 5
SEED = 42
#: From so many members on, a bucket is linked by sorting instead of comparing pairs.
PAIRWISE = 512

#: Row b has the eight bits of byte b, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = (text or b"").lower().split()          # on bytes: A to Z, and the six white-space bytes
    if not words:
        return 0
    if len(words) <= shingle:
        pieces, n = [b" ".join(words)], 1
    else:
        n = len(words) - shingle + 1
        pieces = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype=np.uint64, count=n)
    by_byte = hashes.astype(">u8").view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256, dtype=np.int64)
    counts = np.bincount(by_byte.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint, as a signed long, of every document."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((simhash(t.as_buffer().to_pybytes() if t.is_valid else None, shingle)
                               for t in batch.column(1).cast(pa.binary())), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long")


def block_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("max_bits has to be below the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def least_reached(fps: np.ndarray, free: int, max_bits: int) -> np.ndarray:
    """For each of some distinct fingerprints, the least one that it reaches by steps of at most ``max_bits`` bits.

    ``free``: the bits in which they may differ at all."""
    n, label = len(fps), fps.copy()
    if n < PAIRWISE:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
        while True:
            new = np.where(near, label[None, :], np.uint64(2**64 - 1)).min(axis=1)
            if (new == label).all():
                return label
            label = new
    bits = [np.uint64(1 << b) for b in range(64) if free >> b & 1]
    sorts = []
    for some in combinations(bits, min(max_bits, len(bits))):
        rest = fps & ~np.uint64(sum(map(int, some)))
        order = np.argsort(rest, kind="stable")
        starts = np.flatnonzero(np.r_[True, rest[order][1:] != rest[order][:-1]])
        if len(starts) < n:
            multiple = np.diff(np.r_[starts, n]) > 1
            keep = np.repeat(multiple, np.diff(np.r_[starts, n]))
            runs = np.diff(np.r_[starts, n])[multiple]
            sorts.append((order[keep].astype(np.int32), np.r_[0, np.cumsum(runs)[:-1]], runs))
    while True:
        before = label.copy()
        for order, starts, runs in sorts:
            label[order] = np.repeat(np.minimum.reduceat(label[order], starts), runs)
        if (before == label).all():
            return label


def bucket_links(classes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, total: int = 0) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that keep every component whole."""
    masks = block_masks(max_bits, blocks)
    keyed = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.choice", "k.key", "fp")
    placed = (keyed.repartition(tasks_for(total * len(masks), 500_000), "choice", "key")
              .sortWithinPartitions("choice", "key", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def linked(choice, key, fp):
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1
            a, b = [], []
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(fp)]
            for lo, hi in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
                fps = fp[lo:hi].view(np.uint64)
                least = least_reached(fps, ~masks[choice[lo]] & (2**64 - 1), max_bits)
                moved = least != fps
                a.append(fps[moved])
                b.append(least[moved])
            return pa.RecordBatch.from_arrays(
                [pa.array((np.concatenate(x) if x else np.zeros(0, np.uint64)).view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            if (held[-1][0][-1], held[-1][1][-1]) == (held[0][0][0], held[0][1][0]):
                continue                                     # one bucket so far
            choice, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            last = np.flatnonzero((choice != choice[-1]) | (key != key[-1]))[-1] + 1   # the last bucket may go on
            yield linked(choice[:last], key[:last], fp[:last])
            held = [(choice[last:], key[last:], fp[last:])]
        if held:
            yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return placed.mapInArrow(run, "a long, b long").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id (the least id of those it reaches) of every document."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    distinct, total = classes.agg(F.count(F.lit(1)), F.sum("n")).first()
    roots = components(bucket_links(classes, max_bits, total=distinct))
    # Linked classes take the least document of their component; components may be of any size.
    linked = classes.join(roots, classes["fp"] == roots["node"], "left").drop("node")
    rooted = linked.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m"))
    found = join_by_class(rooted, least, "root", "m", distinct).select("fp", "n", "component_id")
    out = join_by_class(rows, found, "fp", "n", total or 0)
    return out.select(F.col("id").alias(id_col),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the least id (null last), of one id the least hash of
    the text; of rows alike in both, any one."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = F.struct(F.col(f"`{id_col}`").isNull().alias("n"), F.col(f"`{id_col}`").alias("d"), F.xxhash64(text).alias("h"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("own"), text.alias("text"))
    groups = simhash_components(named.select("own", "text"), shingle, max_bits, "own", "text")
    chosen = groups.where("own = component_id").select("own").distinct()
    first = Window.partitionBy("own").orderBy("own")
    return (named.select("row", "own").join(chosen, "own").withColumn("k", F.row_number().over(first))
            .where("k = 1").select("row.*"))


def op4_query(docs: DataFrame) -> DataFrame:
    return simhash_components(docs)
