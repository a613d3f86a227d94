"""Word shingles of whole texts as sets of 64-bit hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
SEGMENT = 1 << 20  # bytes hashed at a time
_U = np.uint64
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_STEPS = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3], dtype=_U)
_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse for every place of a segment."""
    if not _powers:
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(SEGMENT + 1, factor, dtype=_U)
            steps[0] = 1
            _powers.append(np.cumprod(steps))
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a segment; A-Z count as a-z."""
    power, inverse = _tables()
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum((lower.astype(_U) + _U(1)) * power[:len(data)], out=sums[1:])
    hashes = (sums[end] - sums[start]) * inverse[start]
    return mixed(hashes + (end - start).astype(_U) * _STEPS[0]), start


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order. Texts share segments; a text longer than one is
    cut at white space (or, within a single word of that length, hashed by parts)."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) >= SEGMENT:
            yield from _group_hashes(group)
            group, size = [], 0
        if len(text) >= SEGMENT:
            yield _long_hashes(text)
        else:
            group.append(text)
            size += len(text) + 1
    if group:
        yield from _group_hashes(group)


def _group_hashes(group: list[bytes]) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join(group), dtype=np.uint8)
    hashes, start = _word_hashes(data) if len(data) else (np.zeros(0, _U), np.zeros(0, int))
    ends = np.cumsum([len(t) + 1 for t in group])
    return iter(np.split(hashes, np.searchsorted(start, ends[:-1])))


def _long_hashes(text: bytes) -> np.ndarray:
    parts, at, carried = [], 0, None
    while at < len(text):
        stop = min(at + SEGMENT, len(text))
        if stop < len(text):
            cut = max(text.rfind(b, at, stop) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            inside = cut < at
            stop = stop if inside else cut + 1
        else:
            inside = False
        hashes, start = _word_hashes(np.frombuffer(text[at:stop], dtype=np.uint8))
        if carried is not None:
            # this segment goes on with a word that filled the one before
            if len(start) and start[0] == 0:
                carried = mixed(carried * _STEPS[1:2] + hashes[:1])
                hashes = hashes[1:]
            if not (inside and not len(hashes)):
                parts.append(carried)
                carried = None
        if inside and len(hashes):
            carried, hashes = hashes[-1:], hashes[:-1]
        parts.append(hashes)
        at = stop
    if carried is not None:
        parts.append(carried)
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles, ascending; fewer words than ``width`` make one shingle, none make none."""
    n = len(words)
    if not n:
        return words
    if n < width:
        whole = (words * _STEPS[:n]).sum(dtype=_U, keepdims=True)
        return mixed(whole ^ mixed(np.array([n], dtype=_U)))
    total = words[:n - width + 1] * _STEPS[0]
    for k in range(1, width):
        total = total + words[k:n - width + 1 + k] * _STEPS[k]
    return np.unique(mixed(total))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    return map(shingle_set, word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts]))
