"""Token counts at every prefix of a text, by dynamic programming.

Tokens are merged from neighbours, so no token crosses a place between two
characters that stand next to each other in no piece of the vocabulary; the end
of a word before a space is one.  A text, with the space that the library puts
before it, is cut at such places.  The count at a prefix is the count of the
whole segments before it plus the count at a place inside its segment.

Inside a segment the counts come from a recurrence.  The tokens of a prefix
end in exactly one piece that the tokens of the rest accept as neighbour, that
is, the two alone encode to just these two.  With that last piece stored for
every shorter prefix, each further character looks back over the pieces that
could end there: time is linear in the text, and nothing is encoded again.
Segments recur and are remembered, up to a bounded number.

With the counts at hand, the longest prefix within a budget and the count of
any prefix are look-ups.  If no piece is accepted at some place, the prefixes
of that segment are encoded.

Whole counts of many texts are summed from their segments' on arrays; segments
are told apart by a 64-bit hash there.

Defined cases: a null text is an empty one with no tokens; an empty table gives
an empty result; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import ship
from roadlens.llm.piece_hash import PieceHash, PieceTable, tokenizer_path

MARK = "▁"                      # how the vocabulary writes a space
#: Segments and neighbour pairs remembered per Python worker; the memory starts anew when it is full.
MEMORY = 600_000
TAIL = 4
LONG_SEGMENT = 64               # longer ones are not remembered prefix by prefix
#: Bytes of texts that are counted together (a longer text on its own).
TOGETHER = 2 << 20


class PrefixCounts:
    """Token counts of all prefixes under a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = (self.model.is_control, self.model.is_unknown, self.model.is_byte, self.model.is_unused)
        self.pieces = {self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not any(k(i) for k in kinds)}
        # Lengths of pieces by their last TAIL characters; those of shorter ones are looked up as they are met.
        self.long_ends: dict[str, set[int]] = {}
        for p in self.pieces:
            if len(p) >= TAIL:
                self.long_ends.setdefault(p[-TAIL:], set()).add(len(p))
        self.ends: dict[str, tuple[int, ...]] = {}
        # Cuts stand between two ASCII characters that are neighbours in no piece.
        self.cut = np.zeros((256, 256), bool)
        self.cut[:128, :128] = True
        for p in self.pieces:
            for x, y in zip(p.replace(MARK, " "), p.replace(MARK, " ")[1:], strict=False):
                if x < "\x80" and y < "\x80":
                    self.cut[ord(x), ord(y)] = False
        if self.cut[32, 32] or not self.cut[ord("a"), 32]:
            raise ValueError("this vocabulary does not keep words apart at spaces")
        self.hashes = PieceHash()
        self.table, self.totals = PieceTable(), np.zeros(1 << 16, np.int64)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.segments: dict[str, bytes] = {}

    def _encode(self, piece: str) -> list[str]:
        """The pieces of a string, without the space that the library puts before a text: a line end, which no
        piece holds, stands between."""
        return self.model.encode("\n" + piece, out_type=str)[2:]

    def _weight(self, piece: str) -> int:
        return 1 if piece in self.pieces else len(piece.encode())      # an unknown character is its bytes

    def _fits(self, left: str, right: str) -> bool:
        """Whether the two are their own encoding when they stand together."""
        known = self.pairs.get((left, right))
        if known is None:
            want = [x for p in (left, right) if p for x in ([p] if p in self.pieces else [f"<0x{b:02X}>" for b in p.encode()])]
            known = self._encode(left + right) == want
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _sizes(self, tail: str) -> tuple[int, ...]:
        """Sizes that a last piece may have, after these last TAIL characters (or fewer, at the start): the longest first."""
        sizes = {k for k in range(1, len(tail) + 1) if tail[-k:] in self.pieces} | self.long_ends.get(tail, set()) | {1}
        if len(self.ends) >= MEMORY:
            self.ends.clear()
        self.ends[tail] = found = tuple(sorted(sizes, reverse=True))
        return found

    def segment(self, segment: str) -> list[int]:
        """Counts at every prefix of a segment, from the empty one."""
        s = segment.replace(" ", MARK)
        counts, last = [0], [""]
        known_sizes, known_pairs, pieces = self.ends.get, self.pairs.get, self.pieces
        for end in range(1, len(s) + 1):
            tail = s[end - TAIL if end > TAIL else 0:end]
            for size in known_sizes(tail) or self._sizes(tail):
                if size > end:
                    continue
                piece = s[end - size:end]
                if size > TAIL and piece not in pieces:
                    continue
                left = last[end - size]
                fits = known_pairs((left, piece))
                if fits or fits is None and self._fits(left, piece):
                    counts.append(counts[end - size] + (1 if size > 1 or piece in pieces else self._weight(piece)))
                    last.append(piece)
                    break
            else:
                return [len(self._encode(s[:end])) for end in range(len(s) + 1)]
        return counts

    def _segments(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The texts with a space before each, joined; where segments and where texts begin."""
        joined = b"".join(x for t in texts for x in (b" ", t))
        data = np.frombuffer(joined, np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        new = np.r_[True, self.cut[data[:-1], data[1:]]]
        new[starts] = True
        return joined, np.flatnonzero(new), starts

    def whole(self, texts: list[str], budgets: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
        """The token count of each text; and for each budget, the characters of its longest prefix within it."""
        out = np.zeros(len(texts), np.int64)
        fits = [np.fromiter(map(len, texts), np.int64, len(texts)) for _ in budgets]
        some = [i for i, t in enumerate(texts) if t]
        if not some:
            return out, fits
        joined, at, starts = self._segments([texts[i].replace(MARK, " ").encode() for i in some])
        data = np.frombuffer(joined, np.uint8)
        if self.table.used > 2 * MEMORY:
            self.table = PieceTable()
        ends = np.r_[at[1:], len(joined)]
        hashes = self.hashes(data, at)
        number = self.table.find(hashes)
        missed = np.flatnonzero(number < 0)
        if len(missed):
            new, where = np.unique(hashes[missed], return_index=True)
            where = missed[where]
            while self.table.used + len(new) > len(self.totals):
                self.totals = np.r_[self.totals, np.zeros_like(self.totals)]
            self.totals[self.table.used:self.table.used + len(new)] = [
                self.segment(joined[a:b].decode())[-1] for a, b in zip(at[where].tolist(), ends[where].tolist(), strict=True)]
            self.table.add(new)
            number[missed] = self.table.find(hashes[missed])
        each = self.totals[number]
        firsts = np.searchsorted(at, starts)
        out[some] = np.add.reduceat(each, firsts)
        for low, high, start, i in zip(firsts.tolist(), [*firsts[1:].tolist(), len(at)], starts.tolist(), some, strict=True):
            for budget, fit in zip(budgets, fits, strict=True):
                if out[i] > budget:
                    before = np.cumsum(each[low:high]) - each[low:high]
                    # Back from the last segment that begins within the budget to one that has a prefix within it.
                    for k in range(int(np.searchsorted(before, budget, side="right")) - 1, -1, -1):
                        inside = self.segment(joined[at[low + k]:ends[low + k]].decode())
                        most = max(c for c, n in enumerate(inside) if before[k] + n <= budget)
                        if most or k == 0:
                            break
                    # The first character is the space put before the text.
                    fit[i] = max(len(joined[start:at[low + k]].decode()) + most - 1, 0)
        return out, fits

    def text(self, text: str) -> np.ndarray:
        """Counts at every prefix of a text, from the empty one to the whole: one more than it has characters."""
        if not text:
            return np.zeros(1, np.int64)
        joined, at, _ = self._segments([text.replace(MARK, " ").encode()])
        found = []
        for low, high in zip(at.tolist(), [*at[1:].tolist(), len(joined)], strict=True):
            part = joined[low:high].decode()
            known = self.segments.get(part)
            if known is None:
                known = np.array(self.segment(part)[1:], dtype="<i4").tobytes()
                if len(part) <= LONG_SEGMENT:
                    if len(self.segments) >= MEMORY:
                        self.segments.clear()
                    self.segments[part] = known
            found.append(known)
        counts = np.frombuffer(b"".join(found), dtype="<i4").astype(np.int64)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        whole = np.cumsum(counts[np.cumsum(sizes) - 1])
        counts += np.repeat(np.r_[0, whole[:-1]], sizes)
        counts[0] = 0                    # the first character is the space put before the text
        return counts


_LOADED: dict[str, PrefixCounts] = {}


def loaded(path: str) -> PrefixCounts:
    """The model of a Python worker, which keeps its memory of segments from task to task."""
    if path not in _LOADED:
        _LOADED[path] = PrefixCounts(path)
    return _LOADED[path]


def prefix_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", budgets: tuple[int, ...] = (),
                  with_counts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and n_tokens of every document; for each budget, chars_<budget>: the characters of its longest
    prefix of at most so many tokens; ``with_counts``: counts, array<int>, at every prefix."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(tokenizer_path(model))
        for batch in batches:
            texts, low, size = [], 0, 0
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py() or "")
                size += len(texts[-1])
                if size >= TOGETHER or i == batch.num_rows - 1:
                    yield counted(counter, batch.column(0).slice(low, len(texts)), texts)
                    texts, low, size = [], i + 1, 0

    def counted(counter: PrefixCounts, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        totals, fits = counter.whole(texts, budgets)
        columns = [ids, pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(totals), *map(pa.array, fits)]
        if with_counts:
            columns.append(pa.array([counter.text(t).astype(np.int32) for t in texts], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "n_bytes", "n_tokens", *(f"chars_{b}" for b in budgets), *(["counts"] if with_counts else [])]
    schema = f"id {kind}, " + ", ".join(f"{n} {'array<int>' if n == 'counts' else 'long'}" for n in names[1:])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


LIMIT = 4096


def op7_query(docs: DataFrame) -> DataFrame:
    return prefix_counts(docs, budgets=(LIMIT,)).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), f"chars_{LIMIT}")
