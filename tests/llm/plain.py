"""The plain meanings that the operators are tested against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

#: texts at the edges: missing, empty, without words, one word, repeated rows, long, other scripts
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "a b c d e f g"),
    (6, "a b c d e f g"),
    (7, "x y " * 3000),
    (8, "ﬁ K İ 你好 a\x00b \x1f c d " + "z" * 5000),
    (9, "same line\nsame line\n\nsame line\r\n#*$ %&|<>"),
    (None, "a b c d e f g"),
    (None, None),
]


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, size: int = 5) -> set:
    words = SPACED.findall(text or "")
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def similar_classes(sets: list[set], threshold: int) -> list[int]:
    """For each set the place of the first set of its component."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    often = Counter(s for found in sets for s in found)
    index = defaultdict(list)
    for place, found in enumerate(sets):
        ordered = sorted(found, key=lambda s: (often[s], s))
        prefix = ordered[: len(found) - -(-threshold * len(found) // 100) + 1]
        for other in {q for s in prefix for q in index[s]}:
            common = len(found & sets[other])
            if 100 * common >= threshold * (len(found) + len(sets[other]) - common):
                low, high = sorted((find(place), find(other)))
                parent[high] = low
        for s in prefix:
            index[s].append(place)
    return [find(k) for k in range(len(sets))]


def word_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = SPACED.findall(text)
    runs = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)
