"""64-bit fingerprints of words and of every window of a sequence, on numpy arrays inside tasks.

A window's fingerprint is a polynomial over its units modulo 2**64, read off two prefix sums, so all windows of a text
cost a few array passes. Texts are cut into segments, so memory per text is bounded by the text itself plus a segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Windows handled at once; positions inside a segment take the low bits of a packed key.
POSITION_BITS = 18
SEGMENT = 1 << (POSITION_BITS - 1)
_LOW = np.uint64((1 << POSITION_BITS) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: One random odd number per byte value.
BYTE_VALUES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(_BASE, (1 << POSITION_BITS) + 1)
_DOWN = _powers(_INVERSE, (1 << POSITION_BITS) + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(units: np.ndarray) -> np.ndarray:
    """Prefix sums of a segment of at most ``2**POSITION_BITS`` units."""
    sums = np.zeros(len(units) + 1, dtype=np.uint64)
    np.cumsum(units * _UP[: len(units)], out=sums[1:])
    return sums


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of units[start:end], the same wherever in a text the units stand."""
    return mix((sums[end] - sums[start]) * _DOWN[start])


def word_units(words: list[bytes]) -> np.ndarray:
    """One fingerprint per word."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes)
    values = BYTE_VALUES[np.frombuffer(b"".join(words), dtype=np.uint8)]
    out = np.zeros(len(words), dtype=np.uint64)
    at = 0
    while at < len(words):  # a segment of whole words, or one word longer than a segment
        begin = ends[at] - sizes[at]
        upto = max(at + 1, int(np.searchsorted(ends, begin + SEGMENT, side="right")))
        if upto == at + 1 and sizes[at] > SEGMENT:
            out[at] = long_value(values[begin : ends[at]])
        else:
            sums = prefix_sums(values[begin : ends[upto - 1]])
            out[at:upto] = between(sums, ends[at:upto] - sizes[at:upto] - begin, ends[at:upto] - begin)
        at = upto
    return out


def long_value(values: np.ndarray) -> np.uint64:
    """Fingerprint of a unit sequence of any length: that of the fingerprints of its pieces."""
    while len(values) > SEGMENT:
        pieces = [prefix_sums(values[i : i + SEGMENT]) for i in range(0, len(values), SEGMENT)]
        values = np.array([mix(p[-1:] + np.uint64(len(p)))[0] for p in pieces], dtype=np.uint64)
    return mix(prefix_sums(values)[-1:])[0]


def windows(units: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all windows of ``width`` units."""
    parts = []
    for begin in range(0, max(len(units) - width + 1, 0), SEGMENT):
        sums = prefix_sums(units[begin : begin + SEGMENT + width - 1])
        starts = np.arange(len(sums) - width)
        parts.append(between(sums, starts, starts + width))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(units: np.ndarray, width: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Winnowed anchors: every window of ``width`` units owns its leftmost smallest seed of ``seed`` units.

    The choice depends on the window's content only, so equal windows own equal seeds at equal offsets. Yields per
    segment, for each anchor: seed fingerprint, fingerprint of all units its windows cover (with the windows' place
    around the seed), first window, number of windows (both in the whole sequence), offset of the seed in the first.
    """
    reach = width - seed + 1
    for begin in range(0, max(len(units) - width + 1, 0), SEGMENT):
        sums = prefix_sums(units[begin : begin + SEGMENT + width - 1])
        starts = np.arange(len(sums) - seed)
        seeds = between(sums, starts, starts + seed)
        owner = (_sliding_min((seeds & ~_LOW) | starts.astype(np.uint64), reach) & _LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        last = np.concatenate([first[1:], [len(owner)]])
        at = owner[first]
        place = mix(((at - first) << np.int64(32)).astype(np.uint64) + (last - first).astype(np.uint64))
        context = between(sums, first, last - 1 + width) ^ place
        yield seeds[at], context, first + begin, last - first, at - first
