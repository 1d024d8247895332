"""Words, rolling hashes and winnowing over a batch of texts, in numpy.

A batch's texts lie end to end in one UTF-8 buffer. Words are maximal runs of bytes that a
table calls word bytes; a word never crosses from one text to the next. Hashes are
polynomials modulo 2**64 over random byte values, taken from prefix sums and mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)


def not_space() -> np.ndarray:
    """Word bytes: all but ASCII white space."""
    t = np.ones(256, dtype=bool)
    t[[9, 10, 11, 12, 13, 32]] = False
    return t


def alphanumeric() -> np.ndarray:
    """Word bytes: ASCII letters, digits and every byte of a non-ASCII character."""
    t = np.zeros(256, dtype=bool)
    t[48:58] = t[65:91] = t[97:123] = True
    t[128:] = True
    return t


class Powers:
    """BASE**i and its inverse for i below a length that grows as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, m, 1 << 64))])
                self.down = np.concatenate([self.down, self.down * np.uint64(pow(INVERSE, m, 1 << 64))])
        return self.up[:n], self.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts end to end and the n + 1 offsets into them; a null counts as ''."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """starts, ends: bytes of each word; first: n + 1 word numbers, text i has words first[i] to first[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        inside = word_bytes[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) & ~begins[:-1] if len(data) else inside
        self.starts = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) & ~begins[1:] if len(data) else inside
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, values: np.ndarray, powers: Powers) -> np.ndarray:
        up, down = powers.to(len(self.data) + 1)
        with np.errstate(over="ignore"):
            prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(values[self.data] * up[:-1], out=prefix[1:])
            raw = (prefix[self.ends] - prefix[self.starts]) * down[self.starts]
            return mix(raw + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def word_hashes(words: Words, powers: Powers, limit: int = 1 << 18) -> np.ndarray:
    """The words' hashes, taken for about limit bytes at a time to bound memory; where the bytes are cut changes none."""
    out, i, values = [np.zeros(0, dtype=np.uint64)], 0, byte_values()
    while i < len(words):
        a = words.starts[i]
        j = max(i + 1, int(np.searchsorted(words.ends, a + limit, side="right")))
        part = object.__new__(Words)
        part.data, part.starts, part.ends = words.data[a : words.ends[j - 1]], words.starts[i:j] - a, words.ends[i:j] - a
        out.append(part.hashes(values, powers))
        i = j
    return np.concatenate(out)


def gram_hashes(words: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    """The hash of each run of k words, by its first word; runs may cross texts, callers leave those out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers.to(len(words) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * up[:-1], out=prefix[1:])
        return mix((prefix[k:] - prefix[:-k]) * down[:n])


def window_argmin(values: np.ndarray, w: int) -> np.ndarray:
    """For each full window of w values, the place of its least value, the rightmost of equals."""
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    least, place, span = values, np.arange(len(values)), 1

    def join(shift: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[shift : shift + size] <= least[:size]
        return np.where(right, least[shift : shift + size], least[:size]), np.where(right, place[shift : shift + size], place[:size])

    while span * 2 <= w:
        least, place = join(span, len(least) - span)
        span *= 2
    if span < w:
        least, place = join(w - span, n)
    return place


def winnow(grams: np.ndarray, first: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing of several sequences that lie end to end; sequence i is grams[first[i]:first[i + 1]].

    Returns for each selected gram its place in grams, and the first and last window (by the
    place of the window's first gram) of which it is the rightmost least. A sequence of 1 to
    w - 1 grams has one window, all of it.
    """
    sizes = np.diff(first)
    short = (sizes > 0) & (sizes < w)
    if short.any():  # pad to one full window with values that are never less
        padded = np.where(short, w, sizes)
        to = np.concatenate([[0], np.cumsum(padded)])
        where = np.arange(len(grams)) + np.repeat(to[:-1] - first[:-1], sizes)
        wide = np.full(to[-1], np.iinfo(grams.dtype).max, dtype=grams.dtype)
        wide[where] = grams
        back = np.full(to[-1], -1, dtype=np.int64)
        back[where] = np.arange(len(grams))
    else:
        wide, to, back = grams, first, None
    place = window_argmin(wide, w)
    starts = np.arange(len(place))
    end = np.repeat(to[1:], np.diff(to))[: len(place)]
    inside = starts + w <= end
    place, starts = place[inside], starts[inside]
    if not len(place):
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    new = np.concatenate([[True], place[1:] != place[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(place) - 1]])
    chosen, lo, hi = place[new], starts[new], starts[last]
    if back is not None:
        # a padded sequence whose grams all equal the padding value still has its own rightmost gram
        seq = np.searchsorted(to, chosen, side="right") - 1
        chosen = np.minimum(chosen, to[seq] + sizes[seq] - 1)
        chosen, lo, hi = back[chosen], back[lo], back[np.minimum(hi, to[seq] + np.maximum(sizes[seq] - w, 0))]
    return chosen, lo, hi
