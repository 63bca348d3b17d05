"""Simple-8b: as many whole numbers as fit into each 64-bit word, with a selector in its top four bits.

Selector 0 is the escape: the next word is one number of full width. Selector 1 stands for 240 zeros.
The others hold a count of numbers of equal width, the first number in the lowest bits.
"""

from __future__ import annotations

import numpy as np

ESCAPE, ZEROS, RUN = 0, 1, 240
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = tuple(60 // width for width in WIDTHS)
# By selector: how many numbers a word stands for.
HELD = np.array([1, RUN, *COUNTS], dtype=np.int64)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Doubles hold numbers below 2**53 exactly, and their exponent is the length; wider ones go by their top half."""
    high = values >> np.uint64(32)
    lengths = np.frexp(values.astype(np.float64))[1] if not high.any() else None
    if lengths is None:
        low = np.frexp(values.astype(np.uint32).astype(np.float64))[1]
        lengths = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, low)
    return lengths.astype(np.int8)


def _run_starts(fits: np.ndarray, count: int) -> np.ndarray:
    """Places from which ``count`` neighbours fit."""
    places = np.flatnonzero(fits)
    if len(places) < count:
        return places[:0]
    return places[: len(places) - count + 1][places[count - 1 :] - places[: len(places) - count + 1] == count - 1]


def pack(values: np.ndarray) -> np.ndarray:
    """Words for unsigned 64-bit numbers. Each word takes the most numbers that fit from where it begins."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    lengths = _bit_lengths(values)
    selector = np.zeros(n, dtype=np.int8)
    widest = int(lengths.max())
    # From few numbers a word to many, so that the last one that fits stays.
    for k in range(len(WIDTHS) - 1, -1, -1):
        width, count = WIDTHS[k], COUNTS[k]
        if count > n:
            break
        if widest <= width:
            selector[: n - count + 1] = k + 2
        else:
            selector[_run_starts(lengths <= width, count)] = k + 2
    selector[_run_starts(lengths == 0, RUN)] = ZEROS
    step, at, starts = HELD[selector].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = selector[starts].astype(np.int64)
    place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(chosen == ESCAPE)[:-1]))
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), dtype=np.uint64)
    words[place] = chosen.astype(np.uint64) << np.uint64(60)
    words[place[chosen == ESCAPE] + 1] = values[starts[chosen == ESCAPE]]
    for k, (width, count) in enumerate(zip(WIDTHS, COUNTS)):
        mine = chosen == k + 2
        if mine.any():
            numbers = values[starts[mine][:, None] + np.arange(count)]
            shifted = numbers << (np.arange(count, dtype=np.uint64) * np.uint64(width))
            words[place[mine]] |= np.bitwise_or.reduce(shifted, axis=1)
    return words


def unpack(words: np.ndarray) -> np.ndarray:
    """The numbers again, all words of a selector at once."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), dtype=bool)
    for at in np.flatnonzero(chosen == ESCAPE):
        if head[at]:
            head[at + 1] = False
    held = np.where(head, HELD[chosen], 0)
    starts = np.concatenate(([0], np.cumsum(held)))
    values = np.zeros(starts[-1], dtype=np.uint64)
    escaped = np.flatnonzero(head & (chosen == ESCAPE))
    values[starts[escaped]] = words[escaped + 1]
    for k, (width, count) in enumerate(zip(WIDTHS, COUNTS)):
        mine = np.flatnonzero(head & (chosen == k + 2))
        if len(mine):
            shifted = words[mine][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))
            values[starts[mine][:, None] + np.arange(count)] = shifted & np.uint64((1 << width) - 1)
    return values
