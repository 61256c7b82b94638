"""Benchmark decontamination: edit-distance search by random-walk embedding.

Benchmark items are looked for in texts up to an edit distance of MAX_EDITS of
their length, on case-folded texts with single spaces.

* Embedding.  A walk reads a window from its first character on.  At each step
  it writes the character under it, and random bits, drawn once per step and
  character, say whether it moves on.  Two windows at a small edit distance
  fall into step again after each edit, so their walks differ in few places.
* Sampling.  A table's key is made of the characters at random steps of one
  walk; windows that agree on a table's key are candidates.
* Windows have a quarter to a half of the size of the items, 32 characters at
  most.  Every place of every item and every place of every text starts one,
  whatever stands there.  The walks from all places of a text are taken
  together, from their last step to the first: a step's key is that of the step
  behind it, here or one place on, so no walk is followed on its own.  An item
  within the bound has many windows along its length, each with TABLES chances;
  one that agrees is enough.
* Verification.  Candidates whose walks differ nearly everywhere (a large
  Hamming distance) are dropped, and then those whose windows are more than
  MAX_WINDOW_EDITS apart.  The item of any other is aligned with the text
  around it, by bit-parallel dynamic programming; only exact distances within
  the bound count.

The items are the stated query set.  They go to the tasks in slices of bounded
bytes, each against all documents, so neither side is ever sent out whole, and
documents are searched where they are read: nothing is shuffled.

Defined cases: an item shorter than the smallest window is only found as words of its own; a null or empty text has no match; a null or empty item matches
nothing; items of equal text match each; repeated documents each get their
rows; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import ship

MAX_EDITS = 0.2
#: Sizes of windows; an item has the largest that fits into it twice, or the smallest.
SIZES = (8, 16, 32)
#: Steps of a walk per character of a window; a walk moves at every other step.
STEPS = 1.25
#: Characters of a key, by the size of the windows.
SAMPLED = {8: 6, 16: 9, 32: 12}
#: Tables, by the size of the windows, and how many of them share a walk; smaller windows have shorter walks and are fewer.
TABLES = {8: 12, 16: 6, 32: 3}
SHARED = 3
#: Share of the steps at which the walks of a candidate have to agree; unrelated ones agree at a tenth or so.
LEAST_AGREE = 0.4
#: Walks whose steps are compared.
COMPARED = 1
#: Share of a window's characters up to which it may be edited; an item with more edits there has fewer elsewhere.
MAX_WINDOW_EDITS = 0.3
#: Pairs of windows compared at once.
PAIRS = 1 << 13
#: Places of a text whose walks are taken together.
BLOCK = 1 << 15
#: First bits of a key, by which the keys that no item has are passed over.
FILLED_BITS = 20
SEED = 20
#: Bytes of items in a slice; its index has some 50 to 200 times that.
SLICE_BYTES = 2 << 20
#: Characters of texts walked through together.
TOGETHER = 4 << 20


def normal(text: str | None) -> str:
    """Case-folded, with one space for every run of white space."""
    return " ".join(text.casefold().split()) if text else ""


def _symbols(text: str) -> np.ndarray:
    """A byte per character; the walks take characters with equal bytes for equal, the verification does not."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return (codes ^ codes >> np.uint32(8)).astype(np.uint8)


def _reaching(symbols: np.ndarray, starts: np.ndarray, ahead: int) -> np.ndarray:
    """The symbols, with zeros behind them if what is read ahead of a start goes over their end; else no copy is made,
    as the symbols of many texts are passed for a few thousand places at a time."""
    over = int(starts.max(initial=0)) + ahead - len(symbols)
    return np.r_[symbols, np.zeros(over, np.uint8)] if over > 0 else symbols


def window_size(length: int) -> int:
    """The size of the windows of an item."""
    return max((size for size in SIZES if 2 * size <= length), default=min(length, SIZES[0]))


class Walks:
    """The random walks and tables for one size of window."""

    def __init__(self, size: int):
        self.size, self.steps, self.tables = size, int(STEPS * size), TABLES[size]
        rng = np.random.default_rng([SEED, size])
        self.moves = rng.integers(0, 2, (self.tables // SHARED, self.steps, 256), dtype=np.uint8)
        #: The moves of a walk by symbol, 32 steps to a number.
        self.bits = np.zeros((self.tables // SHARED, -(-self.steps // 32), 256), np.int32)
        for step in range(self.steps):
            self.bits[:, step // 32] |= (self.moves[:, step].astype(np.uint32) << np.uint32(step % 32)).view(np.int32)
        #: By walk, table of the walk and step: whether the table reads the step.
        self.reads = np.zeros((self.tables // SHARED, SHARED, self.steps), bool)
        for table in self.reads.reshape(self.tables, self.steps):
            table[rng.choice(self.steps, SAMPLED[size], replace=False)] = True

    def embed(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """What the compared walks write, step by step, for every window."""
        symbols = _reaching(symbols, starts, self.steps + 1)
        out = np.empty((len(starts), COMPARED, self.steps), np.uint8)
        for walk in range(COMPARED):
            at = starts.astype(np.int64)
            for step in range(self.steps):
                out[:, walk, step] = symbols[at]
                at += self.moves[walk, step][out[:, walk, step]]
        return out

    def keys(self, symbols: np.ndarray) -> np.ndarray:
        """Every table's key (row) for the window at every place (column) but the last ``steps``."""
        out = np.empty((self.tables, max(len(symbols) - self.steps, 0)), np.uint32)
        wide = symbols.astype(np.uint32) + np.uint32(1)
        moved = np.empty(len(symbols), np.int32)
        keys, other, mixed = (np.empty((SHARED, len(symbols)), np.uint32) for _ in range(3))
        for walk, reads in enumerate(self.reads):
            keys[:] = 0
            n = len(symbols)
            for step in range(self.steps - 1, -1, -1):
                if step % 32 == 31 or step == self.steps - 1:
                    bits = self.bits[walk, step // 32][symbols]
                n -= 1
                # All ones where the walk goes on: the key is that of the next place, else of this one, a step on.
                np.left_shift(bits[:n], 31 - step % 32, out=moved[:n])
                np.right_shift(moved[:n], 31, out=moved[:n])
                np.bitwise_xor(keys[:, 1:n + 1], keys[:, :n], out=other[:, :n])
                np.bitwise_and(other[:, :n], moved[:n].view(np.uint32), out=other[:, :n])
                np.bitwise_xor(keys[:, :n], other[:, :n], out=keys[:, :n])
                for table in np.flatnonzero(reads[:, step]).tolist():
                    key, mix = keys[table, :n], mixed[table, :n]
                    np.multiply(key, np.uint32(0x9E3779B1), out=key)
                    np.right_shift(key, 15, out=mix)
                    np.bitwise_xor(key, mix, out=key)
                    np.add(key, wide[:n], out=key)
            out[walk * SHARED:(walk + 1) * SHARED] = keys[:, :n]
        return out


class Items:
    """A slice of the benchmark, with its windows' keys."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, t in items if normal(t)]
        self.texts = [normal(t) for _, t in items if normal(t)]
        self.limits = [int(MAX_EDITS * len(t)) for t in self.texts]
        self.symbols = _symbols("\n".join(self.texts))
        self.bases = np.cumsum([0, *(len(t) + 1 for t in self.texts)])
        starts: dict[int, list[np.ndarray]] = {}                      # by size, where windows start
        self.words: dict[str, list[int]] = {}                         # items shorter than a window, by their first word
        for n, text in enumerate(self.texts):
            size = window_size(len(text))
            if size < SIZES[0]:
                self.words.setdefault(text.split(" ")[0], []).append(n)
            else:
                starts.setdefault(size, []).append(self.bases[n] + np.arange(len(text) - size + 1))
        self.tables = {}
        for size, places in starts.items():
            walks, at = Walks(size), np.concatenate(places)
            keys = walks.keys(np.r_[self.symbols, np.zeros(walks.steps, np.uint8)])[:, at]
            filled = np.zeros((walks.tables, 1 << FILLED_BITS), bool)
            found: list[tuple[np.ndarray, np.ndarray]] = []           # the keys of a table, sorted, and where their windows start
            for table in range(walks.tables):
                filled[table, keys[table] >> np.uint32(32 - FILLED_BITS)] = True
                order = np.argsort(keys[table], kind="stable")
                found.append((keys[table][order], at[order].astype(np.int32)))
            self.tables[size] = walks, filled, found

    def _pairs(self, size: int, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in the texts, place in the items) of windows that share a key, for all places of the texts."""
        walks, filled, found = self.tables[size]
        symbols = np.r_[symbols, np.zeros(walks.steps, np.uint8)]
        total = len(self.symbols)
        pairs, n_pairs = [], 0
        for base in range(0, len(symbols) - walks.steps, BLOCK):
            keys = walks.keys(symbols[base:base + BLOCK + walks.steps])
            for table, (known, places) in enumerate(found):
                hits = np.flatnonzero(filled[table].take((keys[table] >> np.uint32(32 - FILLED_BITS)).astype(np.int64)))
                some = keys[table].take(hits)
                low = np.searchsorted(known, some)
                equal = known.take(low, mode="clip") == some
                hits, low = hits[equal], low[equal]
                if not len(hits):
                    continue
                ends = np.cumsum(np.searchsorted(known, some[equal], "right") - low)
                done = 0
                while done < len(hits):                               # places with many equal windows are taken in parts
                    before = int(ends[done - 1]) if done else 0
                    upto = max(done + 1, int(np.searchsorted(ends, before + 64 * PAIRS, "right")))
                    n = np.diff(ends[done:upto], prepend=before)
                    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    pairs.append(np.repeat(hits[done:upto] + base, n) * total + places[np.repeat(low[done:upto], n) + nth])
                    n_pairs += len(nth)
                    done = upto
                    if n_pairs >= PAIRS:
                        yield from self._parts(pairs)
                        pairs, n_pairs = [], 0
        yield from self._parts(pairs)

    def _parts(self, pairs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        both = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        for part in range(0, len(both), PAIRS):
            yield np.divmod(both[part:part + PAIRS], len(self.symbols))

    def candidates(self, texts: list[str]) -> set[tuple[int, int, int]]:
        """(text, item, where the item would start in the text) for all windows that share a key and are close."""
        out = set()
        bases = np.cumsum([0, *(len(t) + 1 for t in texts)])
        symbols = _symbols("\n".join(texts))
        for size, (walks, *_) in self.tables.items():
            for at, of in self._pairs(size, symbols):
                (texts_at, which), (items_at, what) = (np.unique(x, return_inverse=True) for x in (at, of))
                close = (walks.embed(symbols, texts_at)[which] == walks.embed(self.symbols, items_at)[what]).mean(axis=2).max(axis=1) >= LEAST_AGREE
                at, of, what = at[close], of[close], what[close]
                close = _apart(self.symbols[items_at[:, None] + np.arange(size)], what, symbols, at) <= MAX_WINDOW_EDITS * size
                at, of = at[close], of[close]
                text, item = (np.searchsorted(b, x, side="right") - 1 for b, x in ((bases, at), (self.bases, of)))
                out.update(zip(text.tolist(), item.tolist(), (at - bases[text] - of + self.bases[item]).tolist(), strict=True))
        if self.words:
            for n, text in enumerate(texts):
                at = 0
                for word in text.split(" "):
                    out.update((n, item, at) for item in self.words.get(word, ()))
                    at += len(word) + 1
        return out

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) for the best place of every item in every text, within the bound."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        checked: dict[tuple[int, int], list[int]] = {}
        for text, item, place in sorted(self.candidates(texts)):
            limit = self.limits[item]
            done = checked.setdefault((text, item), [])
            if done and place - done[-1] <= limit // 2:            # the same place, as another window sees it
                continue
            done.append(place)
            # The alignment's start may differ from the guess by the edits before the window, and by the skip above.
            low = max(0, place - 2 * limit)
            around = texts[text][low:place + len(self.texts[item]) + 2 * limit]
            edits, start, end = aligned(self.texts[item], around)
            if edits <= limit:
                best[text, item] = min(best.get((text, item), (edits, low + start, low + end)), (edits, low + start, low + end))
        return [(text, item, start, end, edits) for (text, item), (edits, start, end) in best.items()]


def _apart(patterns: np.ndarray, which: np.ndarray, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least edit distance of a pattern (row of 8, 16 or 32 symbols), one for each place in the symbols, to what starts
    there: Myers's bit vectors, all places at once."""
    size = patterns.shape[1]
    kind = np.dtype(f"<u{size // 8}")
    has = np.zeros((len(patterns), 256), kind)                    # where a pattern has a symbol
    for bit in range(size):
        has[np.arange(len(patterns)), patterns[:, bit]] |= kind.type(1 << bit)
    has, which = has.ravel(), which.astype(np.int64) << 8
    one, top = kind.type(1), kind.type(size - 1)
    reach = size + int(MAX_WINDOW_EDITS * size)
    symbols = _reaching(symbols, starts, reach + 1)
    plus, minus = np.full(len(starts), ~kind.type(0)), np.zeros(len(starts), kind)
    score = np.full(len(starts), size, np.int8)
    least = score.copy()
    for step in range(reach):
        eq = has[which | symbols[starts + step]]
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(across | plus), plus & across
        score += (up >> top).astype(np.int8)
        score -= (down >> top).astype(np.int8)
        up, down = up << one | one, down << one
        vertical = eq | minus
        plus, minus = down | ~(vertical | up), up & vertical
        np.minimum(least, score, out=least)
    return least


def _ends(pattern: str, text: str) -> list[int]:
    """The least edit distance of the pattern to a part of the text that ends at each place (Myers's bit vectors)."""
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    n = len(pattern)
    mask, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, out = mask, 0, n, [n]
    for c in text:
        eq = places.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(across | plus) & mask, plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & mask, down << 1 & mask
        vertical = eq | minus
        plus, minus = down | ~(vertical | up) & mask, up & vertical
        out.append(score)
    return out


def aligned(pattern: str, text: str) -> tuple[int, int, int]:
    """(edits, start, end) of the part of the text closest to the pattern, the first of equals by its end."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at, at + len(pattern)
    ends = _ends(pattern, text)
    edits = min(ends)
    end = ends.index(edits)
    back = _ends(pattern[::-1], text[:end][::-1])
    return edits, end - back.index(edits), end


def _slices_of(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items, in slices of SLICE_BYTES on average."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // SLICE_BYTES))
    for n in range(slices):
        yield [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == n).collect()]


def _found(batch: pa.RecordBatch, column: int, items: Items) -> Iterator[tuple[int, int, list[str], list[tuple]]]:
    """For runs of a batch's rows: first row, rows and the matches, whose first number is the row in the run."""
    low, texts, size = 0, [], 0
    for i in range(batch.num_rows):
        texts.append(normal(batch.column(column)[i].as_py()))
        size += len(texts[-1])
        if size >= TOGETHER or i == batch.num_rows - 1:
            yield low, len(texts), items.matches(texts)
            low, texts, size = i + 1, [], 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """id, item, start, end (in the normal form of the text), edits and similarity of every item found in a document."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "item", "start", "end", "edits", "similarity"]

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value)
            for batch in batches:
                for low, _, found in _found(batch, 1, items):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array([low + r[0] for r in found], pa.int32())),
                        pa.array([items.ids[r[1]] for r in found], _arrow(item_kind)),
                        *(pa.array([r[i] for r in found], pa.int32()) for i in (2, 3, 4)),
                        pa.array([1 - r[4] / len(items.texts[r[1]]) for r in found], pa.float64())], names)

        return rows.mapInArrow(run, f"id {kind}, item {item_kind}, start int, end int, edits int, similarity double")

    found = [search(spark.sparkContext.broadcast(part)) for part in _slices_of(benchmark, item_col, item_text_col)]
    return reduce(DataFrame.unionByName, found).withColumnsRenamed({"id": id_col, "item": item_col})


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns, in which no item is found.  They are filtered where they are read."""
    spark = docs.sparkSession
    ship(spark)
    column = docs.columns.index(text_col)

    def clean(rows: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for low, _, found in _found(batch, column, items):
                    keep[[low + r[0] for r in found]] = False
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(run, docs.schema)

    for part in _slices_of(benchmark, item_col, item_text_col):
        docs = clean(docs, spark.sparkContext.broadcast(part))
    return docs


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}[kind]


def op6_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)
