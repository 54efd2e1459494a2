"""Counts of words, characters and repeats in every text of a chunk."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import SPACED, Hasher, find_words, mix, windows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_chars_all")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][offsets])


def counts_of(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> np.ndarray:
    """COUNTS (rows) of the texts (columns) that stand one after another in `data`."""
    n = len(offsets) - 1
    words = find_words(data, offsets, SPACED)
    out = np.zeros((len(COUNTS), n), np.int64)
    out[0] = words.counts
    code_point = (data & 0xC0) != 0x80
    out[1] = per_text(SPACED[data] & code_point, offsets)
    out[2] = per_text(_SYMBOL[data], offsets)
    out[6] = per_text(_UPPER[data], offsets)
    out[7] = per_text(code_point, offsets)

    # lines: between line feeds and the ends of texts
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.r_[offsets[:-1], feeds + 1])
    ends = np.sort(np.r_[feeds, offsets[1:]])
    text = np.repeat(np.arange(n), per_text(data == 10, offsets) + 1)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, text = starts[worded], ends[worded], text[worded]
    out[5] = np.bincount(text, minlength=n)
    with np.errstate(over="ignore"):
        keys = mix(hasher.ranges(data, starts, ends) + mix(text.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    out[3] = out[5] - np.bincount(text[first], minlength=n)

    hashes = hasher.ranges(data, words.starts, words.ends)
    runs, at = windows(words, hashes, 3)
    with np.errstate(over="ignore"):
        runs = mix(runs + mix(words.text[at].astype(np.uint64)))
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    again = np.zeros(len(runs), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words.starts), bool)
    for k in range(3):
        covered[at[again] + k] = True
    out[4] = np.diff(np.r_[0, np.cumsum(covered)][words.bounds])
    return out
