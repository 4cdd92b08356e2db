"""Sets of hashed word sequences, for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
#: texts worked on at once
STEP = 2000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that leaves no structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Sets:
    """``values[offsets[i]:offsets[i + 1]]`` is the set of document ``rows[i]``, in ascending order."""

    rows: np.ndarray
    offsets: np.ndarray
    values: np.ndarray


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all words, in order: the runs of a-z and 0-9 in the lower-cased texts."""
    lowered = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\n".join([*lowered, b""]), np.uint8)
    # letters and digits, as ranges of unsigned bytes
    inside = ((data - np.uint8(97)) < 26) | ((data - np.uint8(48)) < 10)
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        change = np.concatenate(([0], change))
    begin, end = change[0::2], change[1::2]
    if not begin.size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # a polynomial over the bytes of each word, from running sums; it does not depend on the word's place
    n = data.size
    power = _powers(ODD, n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    hashes = mixed((sums[end] - sums[begin]) * _powers(INVERSE, n)[begin])
    per_text = np.searchsorted(begin, np.append(starts, n))
    return hashes, np.repeat(np.arange(len(texts)), np.diff(per_text))


def shingle_sets(texts: list[str | None], width: int, min_words: int) -> Sets:
    """The sets of ``width``-word sequences of the texts with at least ``min_words`` words (and at least ``width``)."""
    words, text = word_hashes(texts)
    enough = np.bincount(text, minlength=len(texts)) >= max(min_words, width)
    if words.size < width or not enough.any():
        return Sets(np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint64))
    many = words.size - width + 1
    shingle = np.zeros(many, np.uint64)
    for i in range(width):
        shingle = (shingle ^ words[i : i + many]) * ODD
        shingle ^= shingle >> np.uint64(29)
    shingle = mixed(shingle)
    first = text[:many]
    valid = (first == text[width - 1 :]) & enough[first]
    shingle, first = shingle[valid], first[valid]
    # sorted by text and value: the text in the upper bits, the upper bits of the value below them
    order = np.argsort((first.astype(np.uint64) << np.uint64(52)) | (shingle >> np.uint64(12)))
    shingle, first = shingle[order], first[order]
    new = np.ones(shingle.size, bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (first[1:] != first[:-1])
    shingle, first = shingle[new], first[new]
    rows, offsets = np.unique(first, return_index=True)
    return Sets(rows, np.append(offsets, shingle.size), shingle)
