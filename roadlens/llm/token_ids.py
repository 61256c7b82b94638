"""Token ids of whole texts by the tokenizers library, with a memory of words.

A byte-level vocabulary splits a text into words before it merges, and a space
goes with the word after it.  Where every space stands between two characters
that are no white space, a cut before each space is a cut between two of those
words.  So are cuts between letters, stops and a line end, within what stands
between two spaces, if there is nothing else in it.  The pieces can be encoded
on their own, and they recur: a Python worker remembers the ids of each, up to
a bounded number, and the library encodes only pieces that are new.  Any other
text is encoded in one go.

Many texts are cut at once, on the array of their bytes.  Pieces are told apart
by a 64-bit hash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

from roadlens.llm.piece_hash import PieceHash, PieceTable, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
#: Pieces remembered per Python worker; the memory starts anew when it is full.
PIECES = 1_200_000
#: Bytes of texts that are cut together (a longer text on its own).
TOGETHER = 2 << 20

_WHITE_BY_SPACE = re.compile(r"\s | \s")

# Classes of bytes.  A byte that starts or goes on a letter up to U+023F is a letter's: those are the letters for
# which all versions of Unicode agree.
_OTHER, _SPACE, _LETTER, _STOP, _LINE = range(5)
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord(" ")], _CLASS[ord("\n")] = _SPACE, _LINE
_CLASS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = _LETTER
_CLASS[[ord(c) for c in ".,!?;:|"]] = _STOP


def _separable(text: str) -> bool:
    """Whether no space has white space beside it."""
    if "  " in text or " \n" in text or "\n " in text:
        return False
    return text.replace("\n", "").isprintable() or not _WHITE_BY_SPACE.search(text)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, that begin at ``starts`` in an array of bytes."""
    kind = _CLASS[data]
    # A multiplication or a division sign, or an empty line, is something else.
    odd = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7)) + 1
    kind[odd[data[odd - 1] == 0xC3]] = _OTHER
    lines = np.flatnonzero(kind == _LINE)
    kind[lines[1:][np.diff(lines) == 1]] = _OTHER
    words = np.zeros(len(data), bool)
    words[starts] = True
    words[kind == _SPACE] = True
    first = np.flatnonzero(words)
    # Nothing is cut inside a word with other bytes; a byte that only goes on, after a byte of another class, is one.
    other = np.add.reduceat((kind == _OTHER).astype(np.int32), first) > 0
    change = np.r_[False, (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)]
    change &= ~np.repeat(other, np.diff(np.r_[first, len(data)]))
    return np.flatnonzero(words | change)


class TokenIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.hashes = PieceHash()
        # Ids of tokens that begin with a space, as the byte-level alphabet writes it.
        self.after_space = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.after_space[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True
        self._forget()

    def _forget(self) -> None:
        self.table = PieceTable()                            # numbers of pieces, by hash
        self.first, self.size, self.ids = (np.zeros(n, t) for n, t in ((1 << 16, np.int64), (1 << 16, np.int32), (1 << 18, self.dtype)))
        self.used = 0

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Encodes new pieces.  Letters after a space are encoded as one text: its tokens that begin with a space
        are where pieces begin."""
        plain = np.fromiter((p[0] == " " and p[1:].isalpha() for p in pieces), bool, len(pieces))
        flat, starts = np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if plain.any():
            flat = np.array(self._encoded(["".join([p for p, x in zip(pieces, plain.tolist(), strict=True) if x])])[0], self.dtype)
            starts = np.flatnonzero(self.after_space[flat])
            if len(starts) != plain.sum():
                plain[:], flat, starts = False, flat[:0], starts[:0]
        rest = self._encoded([p for p, x in zip(pieces, plain.tolist(), strict=True) if not x])
        rest_sizes = np.fromiter(map(len, rest), np.int32, len(rest))
        found = np.concatenate([flat, np.fromiter(chain.from_iterable(rest), self.dtype, int(rest_sizes.sum()))])
        first, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int32)
        first[plain], size[plain] = starts, np.diff(np.r_[starts, len(flat)])
        first[~plain], size[~plain] = len(flat) + np.cumsum(rest_sizes) - rest_sizes, rest_sizes
        n = self.table.used
        while n + len(pieces) > len(self.first):
            self.first, self.size = (np.r_[x, np.zeros_like(x)] for x in (self.first, self.size))
        while self.used + len(found) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.first[n:n + len(pieces)] = self.used + first
        self.size[n:n + len(pieces)] = size
        self.ids[self.used:self.used + len(found)] = found
        self.used += len(found)
        self.table.add(hashes)

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts that are separable and not empty, one after another, and how many each has."""
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = np.r_[0, ends[:-1]]
        at = cuts(data, starts)
        if self.table.used > PIECES:
            self._forget()
        hashes = self.hashes(data, at)
        number = self.table.find(hashes)
        missed = np.flatnonzero(number < 0)
        if len(missed):
            new, where = np.unique(hashes[missed], return_index=True)
            where = missed[where]
            highs = np.r_[at, len(data)][where + 1].tolist()
            self._learn(new, [joined[a:b].decode() for a, b in zip(at[where].tolist(), highs, strict=True)])
            number[missed] = self.table.find(hashes[missed])
        size = self.size[number].astype(np.int64)
        before = np.cumsum(size) - size
        ids = self.ids[np.arange(int(size.sum())) + np.repeat(self.first[number] - before, size)]
        return ids, np.add.reduceat(size, np.searchsorted(at, starts))

    def batches(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of the texts: their ids, one text after another, and how many each text has."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield self._some(held)
                held, size = [], 0
        if held:
            yield self._some(held)

    def _some(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        separable = [bool(t) and _separable(t) for t in texts]
        if all(separable):
            return self._cut([t.encode() for t in texts])
        sizes = np.zeros(len(texts), np.int64)
        cut = [i for i, s in enumerate(separable) if s]
        whole = [i for i, (s, t) in enumerate(zip(separable, texts, strict=True)) if t and not s]
        ids: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        if cut:
            flat, sizes[cut] = self._cut([texts[i].encode() for i in cut])
            for i, part in zip(cut, np.split(flat, np.cumsum(sizes[cut])[:-1]), strict=True):
                ids[i] = part
        for i, found in zip(whole, self._encoded([texts[i] for i in whole]), strict=True):
            ids[i] = np.array(found, self.dtype)
            sizes[i] = len(found)
        return np.concatenate(ids), sizes


_LOADED: dict[str, TokenIds] = {}


def loaded(vocabulary: str = VOCABULARY) -> TokenIds:
    """The encoder of a Python worker, which keeps its memory from task to task."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = TokenIds(tokenizer_path(vocabulary))
    return _LOADED[vocabulary]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
