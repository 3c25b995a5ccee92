"""Content-defined anchors: places that two equal windows of bytes always share."""

from __future__ import annotations

import hashlib

import numpy as np

GRAM = 64
# Bytes whose hashes are made together: few enough for a core's cache.
CHUNK = 1 << 15
_FACTORS = tuple(np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93,
    0xA0761D6478BD642F))
_BYTES = (np.arange(1, 257, dtype=np.uint64) * _FACTORS[0]) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(23))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_hashes(data: np.ndarray, doublings: int = len(_FACTORS)) -> np.ndarray:
    """A 64-bit hash of the 2**doublings bytes from every position on; the last positions have none."""
    held, span = _BYTES[data], 1
    for factor in _FACTORS[:doublings]:
        ahead = held[span:]
        held = held[:len(ahead)] * factor + ahead
        held ^= held >> np.uint64(29)
        span *= 2
    return np.concatenate([held, np.full(min(span - 1, len(data)), _NONE)])


def _sliding(values: np.ndarray, size: int, pick, fill) -> np.ndarray:
    """The pick (least or greatest) of ``size`` values from every position on."""
    held, span = values, 1
    while span < size:
        step = min(span, size - span)
        held = pick(held, np.concatenate([held[step:], np.full(min(step, len(held)), fill)]))
        span += step
    return held


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the least grams of all windows of ``window`` bytes that lie in one row.

    Equal windows have equal grams, so the same places of them are anchors.
    Works on chunks of the bytes, so rows of any length need little memory. Returned are positions, hashes of
    the grams, and begin and end of all bytes that windows with this anchor can cover.
    """
    reach = window - GRAM + 1
    found, hashes, around = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros((0, 2), np.int64)]
    if window < GRAM:
        raise ValueError(f"a window has at least {GRAM} bytes")
    for first in range(0, len(data), CHUNK):
        low, high = max(first - reach, 0), min(first + CHUNK + 2 * window, len(data))
        part = data[low:high]
        ends = offsets[1:][np.searchsorted(offsets[1:], low, side="right"):]
        ends = ends[:np.searchsorted(ends, high, side="left") + 1]
        starts = np.concatenate([[low], ends])[:len(ends)]
        room = np.repeat(ends, np.maximum(np.minimum(ends, high) - starts, 0))[:len(part)] - np.arange(low, high)
        grams = gram_hashes(part)
        grams[room < GRAM] = _NONE
        least = _sliding(grams, reach, np.minimum, _NONE)
        least[room < window] = 0
        greatest = _sliding(least[::-1], reach, np.maximum, np.uint64(0))[::-1]
        here = np.flatnonzero((greatest == grams) & (room >= GRAM)) + low
        here = here[(here >= first) & (here < first + CHUNK)]
        found.append(here)
        hashes.append(grams[here - low])
        row = np.searchsorted(offsets, here, side="right") - 1
        begin = np.maximum(here - reach + 1, offsets[row])
        end = np.minimum(here + window, offsets[row + 1])
        around.append(np.stack([begin, end], 1))
    return np.concatenate(found), np.concatenate(hashes), np.concatenate(around)


def segment_digests(data: np.ndarray, place: np.ndarray, around: np.ndarray, key: bytes) -> np.ndarray:
    """A keyed digest of the bytes around each anchor and of where it stands in them.

    Who writes the texts does not know the key, so nobody can make different bytes that count as equal.
    """
    held, keyed, digests = memoryview(np.ascontiguousarray(data)), hashlib.blake2b(digest_size=8, key=key), []
    for a, b in around.tolist():
        one = keyed.copy()
        one.update(held[a:b])
        digests.append(one.digest())
    digests = b"".join(digests)
    return np.frombuffer(digests, "<u8") ^ (place - around[:, 0]).astype(np.uint64) * _FACTORS[1]
