"""Sets of hashed word shingles of whole texts, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD6E8FEB86659FD93)
CHUNK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as they were needed."""

    size = 0

    @classmethod
    def upto(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.size < size:
            cls.size = max(size, CHUNK)
            cls.up = cls.table(BASE)
            cls.down = cls.table(pow(BASE, -1, 1 << 64))
        return cls.up, cls.down

    @classmethod
    def table(cls, base: int) -> np.ndarray:
        factors = np.full(cls.size, base, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and its hash. Words are runs of other bytes than blanks."""
    raw = LOWER[np.frombuffer(data, np.uint8)]
    word = ~BLANK[raw]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    up, down = Powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * down[starts]
    return starts, mix(hashes + (stops - starts).astype(np.uint64) * STEP)


def shingle_sets(texts: list[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """Of each text: its distinct shingles as sorted hashes. A text of fewer words is one
    shingle; one without words has none."""
    waiting: list[bytes] = []
    held = 0
    for text in texts:
        waiting.append((text or "").encode())
        held += len(waiting[-1])
        if held > CHUNK:
            yield from _sets(waiting, size)
            waiting, held = [], 0
    yield from _sets(waiting, size)


def _sets(parts: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not parts:
        return
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])
    starts, hashes = word_hashes(b"\n".join(parts))
    cuts = np.searchsorted(starts, begins)
    runs = hashes.copy()
    for k in range(1, size):
        runs = runs[:-1] * STEP + hashes[k:]
    runs = mix(runs)
    for first, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        count = stop - first
        if count >= size:
            found = np.sort(runs[first:stop - size + 1])
            if len(found) > 1:
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            yield found
        elif count:
            short = hashes[first:first + 1].copy()
            for k in range(first + 1, stop):
                short = short * STEP + hashes[k]
            yield mix(short + np.uint64(count))
        else:
            yield np.zeros(0, np.uint64)
