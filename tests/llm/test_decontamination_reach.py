"""Windows at the end of the symbols, and no copy of the symbols for the others."""

import numpy as np

from roadlens.llm import decontamination as D


def test_symbols_are_only_copied_at_their_end():
    rng = np.random.default_rng(1)
    symbols = rng.integers(97, 100, 300).astype(np.uint8)
    assert D._reaching(symbols, np.array([3, 258]), 42) is symbols
    assert len(D._reaching(symbols, np.array([3, 299]), 42)) == 341
    assert D._reaching(symbols, np.zeros(0, np.int64), 42) is symbols
    padded = np.r_[symbols, np.zeros(64, np.uint8)]
    starts, patterns = np.arange(300), padded[rng.integers(0, 300, 20)[:, None] + np.arange(32)]
    which = rng.integers(0, 20, 300)
    assert (D._apart(patterns, which, symbols, starts) == D._apart(patterns, which, padded, starts)).all()
    walks = D.Walks(32)
    assert (walks.embed(symbols, starts) == walks.embed(padded, starts)).all()
