"""Suffix sorting in two stages, with numpy, for many short segments at once.

Segments are laid end to end, each followed by a mark below all bytes. Suffixes smaller than their
successors (type B) are sorted directly; all others (type A) follow from them by scanning the buckets
of first characters upwards: whenever a suffix is passed, the one that starts a place earlier takes
the next free place in its own bucket. A bucket is scanned as a whole.
"""

from __future__ import annotations

import numpy as np

DEPTH = 56  # characters up to which suffixes are told apart
PACK = 7  # characters of nine bits in a number


def laid_out(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Characters (byte + 1, marks 0) of all segments, and the place where each segment starts."""
    lengths = np.array([len(s) + 1 for s in segments], dtype=np.int64)
    text = np.frombuffer(b"\0".join(segments) + b"\0", dtype=np.uint8).astype(np.uint16) + np.uint16(1)
    starts = np.cumsum(lengths) - lengths
    text[starts + lengths - 1] = 0
    return text, starts


def words(text: np.ndarray) -> np.ndarray:
    """Per place the next ``PACK`` characters as one number, and enough places behind the end."""
    padded = np.concatenate([text, np.zeros(DEPTH + PACK, dtype=np.uint16)]).astype(np.uint64)
    n = len(padded) - PACK + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(PACK):
        out = (out << np.uint64(9)) | padded[k:n + k]
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the one after it; runs of one character take
    the type of what follows them."""
    n = len(text)
    change = np.flatnonzero(text[:-1] != text[1:])
    rises = text[change] < text[change + 1]
    # what follows the last change has nothing behind it to be smaller than
    return np.repeat(np.append(rises, True), np.diff(np.concatenate([[0], change + 1, [n]])))


def directly_sorted(places: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes: by the first characters, then those that are still
    equal by the next, and so on."""
    key = packed[places]
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    equal = key[1:] == key[:-1]
    for k in range(PACK, DEPTH, PACK):
        tied = np.flatnonzero(np.concatenate([[False], equal]) | np.concatenate([equal, [False]]))
        if not len(tied):
            break
        # runs of equal places keep their slots; within a run the next characters decide, where they
        # are not all the same
        run = np.cumsum(~np.concatenate([[False], equal]))[tied]
        own = places[tied]
        key = packed[own + k]
        mixed = np.zeros(run[-1] + 1, dtype=bool)
        mixed[run[1:][(run[1:] == run[:-1]) & (key[1:] != key[:-1])]] = True
        some = np.flatnonzero(mixed[run])
        order = some[np.lexsort((key[some], run[some]))]
        places[tied[some]] = own[order]
        key[some] = key[order]
        same = np.zeros(len(places), dtype=bool)
        same[tied[1:]] = (run[1:] == run[:-1]) & (key[1:] == key[:-1])
        equal = same[1:]
    return places


def suffix_array(text: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """All places in the order of their suffixes (as far as ``DEPTH`` characters tell)."""
    n = len(text)
    is_b = smaller_than_next(text)
    size = np.bincount(text, minlength=257)
    start = np.concatenate([[0], np.cumsum(size)])
    count_b = np.bincount(text[is_b], minlength=257)
    direct = directly_sorted(np.flatnonzero(is_b), packed)
    order = np.empty(n, dtype=np.int64)
    at = 0
    for c in np.flatnonzero(count_b):
        stop = start[c + 1]
        order[stop - count_b[c]:stop] = direct[at:at + count_b[c]]
        at += count_b[c]
    free = start[:-1].copy()

    def induce(passed: np.ndarray) -> None:
        before = passed[passed > 0] - 1
        before = before[~is_b[before]]
        if not len(before):
            return
        first = text[before]
        by_bucket = np.argsort(first, kind="stable")
        before, first = before[by_bucket], first[by_bucket]
        edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1], [True]]))
        for low, high in zip(edges[:-1], edges[1:]):
            c = first[low]
            order[free[c]:free[c] + high - low] = before[low:high]
            free[c] += high - low

    for c in np.flatnonzero(size):
        at = start[c]
        while at < free[c]:
            upto = free[c]
            induce(order[at:upto])
            at = upto
        induce(order[start[c + 1] - count_b[c]:start[c + 1]])
    return order


def _least(segments: list[bytes], value: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per place the least value and the segment, then where segments start and end."""
    text, starts = laid_out(segments)
    packed = words(text)
    ends = np.concatenate([starts[1:], [len(text)]]) - 1
    owner = np.repeat(np.arange(len(segments)), ends - starts + 1)
    order = suffix_array(text, packed)
    order = order[order + length <= ends[owner[order]]]
    least = np.zeros(len(text), dtype=np.int64)
    if len(order):
        # common prefix of neighbours, as far as the window
        same = np.ones(len(order) - 1, dtype=bool)
        for k in [*range(0, length - PACK, PACK), length - PACK]:
            same &= packed[order[1:] + k] == packed[order[:-1] + k]
        group = np.concatenate([[True], ~same])
        sums = np.minimum.reduceat(value[owner[order]], np.flatnonzero(group))
        least[order] = sums[np.cumsum(group) - 1]
    return least, owner, starts, ends


def least_by_window(segments: list[bytes], value: np.ndarray, length: int) -> list[np.ndarray]:
    """For every segment and each of its windows of ``length`` bytes the least ``value`` among the
    segments that contain the same window anywhere."""
    least, _, starts, ends = _least(segments, value, length)
    return [least[s:max(e - length + 1, s)] for s, e in zip(starts, ends)]


def least_runs(segments: list[bytes], value: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The same as runs of windows with one value: the segment's number, the first window, how many
    windows, and the value."""
    least, owner, starts, ends = _least(segments, value, length)
    place = np.arange(len(least))
    place = place[place + length <= ends[owner]]
    own, least = owner[place], least[place]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    return own[first], (place - starts[own])[first], np.diff(np.append(first, len(place))), least[first]
