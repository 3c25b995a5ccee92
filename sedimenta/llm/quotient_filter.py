"""Counting quotient filters of packed n-grams: sorted, lossless, merged by merging.

An n-gram of two to four 32-bit ids is a key of 64, 96 or 128 bits. An
invertible permutation spreads the keys evenly. The upper bits of a permuted key are its
quotient, which the filter holds only as the number of keys in each slot, in unary; all other bits
are the remainder, held in full, so a key can be had back exactly. Counts take a byte, larger ones a further long.

A filter covers one range of permuted keys (their first ``range_bits`` bits) and keeps them in
order, so filters of one range merge by merging their runs.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

HEAD = struct.Struct("<BBIQQ")
_ROUNDS = tuple(np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_32 = np.uint64(0xFFFFFFFF)
MAX_QUOTIENT = 40


def _mix(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    held = (values + factor) * _ROUNDS[0]
    held ^= held >> np.uint64(29)
    held *= factor
    held ^= held >> np.uint64(32)
    return held


def _halves(words: int) -> tuple[np.uint64, np.uint64]:
    """The bits of both halves of a key of 2, 3 or 4 ids."""
    whole = np.uint64(0xFFFFFFFFFFFFFFFF)
    return {2: (_32, _32), 3: (whole, _32), 4: (whole, whole)}[words]


def permute(ids: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The permuted keys of n-grams given as one array of ids for each place: upper 64 bits, and the rest."""
    ids = [np.asarray(i).astype(np.uint64) for i in ids]
    half = max(len(ids) // 2, 1) if len(ids) != 3 else 2
    left, right = (_join(part) for part in (ids[:half], ids[half:]))
    left_bits, right_bits = _halves(len(ids))
    for number, factor in enumerate(_ROUNDS):
        if number % 2:
            left = left ^ (_mix(right, factor) & left_bits)
        else:
            right = right ^ (_mix(left, factor) & right_bits)
    return (left << np.uint64(32) | right, np.zeros(len(left), np.uint64)) if len(ids) == 2 else (left, right)


def _join(ids: list[np.ndarray]) -> np.ndarray:
    return ids[0] if len(ids) == 1 else ids[0] << np.uint64(32) | ids[1]


def unpermute(upper: np.ndarray, lower: np.ndarray, words: int) -> list[np.ndarray]:
    """The ids of permuted keys, one array for each place."""
    left, right = (upper >> np.uint64(32), upper & _32) if words == 2 else (upper, lower)
    left_bits, right_bits = _halves(words)
    for number, factor in reversed(list(enumerate(_ROUNDS))):
        if number % 2:
            left = left ^ (_mix(right, factor) & left_bits)
        else:
            right = right ^ (_mix(left, factor) & right_bits)
    parts = [left] if words == 2 else [left >> np.uint64(32), left & _32]
    parts += [right >> np.uint64(32), right & _32] if words == 4 else [right]
    return [p.astype(np.int64) for p in parts]


def key_order(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Ascending order of keys; runs that are sorted already are only merged."""
    order = np.argsort(upper, kind="stable")
    ranked, rest = upper[order], lower[order]
    wrong = (ranked[1:] == ranked[:-1]) & (rest[1:] < rest[:-1])
    if wrong.any():  # equal upper halves: rare, unless the keys are equal
        order = order[np.lexsort((rest, ranked))]
    return order


def summed(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and their counts added up."""
    if not len(upper):
        return upper, lower, counts
    order = key_order(upper, lower)
    upper, lower, counts = upper[order], lower[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (upper[1:] != upper[:-1]) | (lower[1:] != lower[:-1])]))
    return upper[first], lower[first], np.add.reduceat(counts, first)


def encode(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray, words: int, range_bits: int) -> bytes:
    """The filter of ascending distinct keys of one range."""
    size = len(upper)
    choices = [q for q in range(8, MAX_QUOTIENT + 1, 8) if q >= range_bits]
    # Slots cost a bit each, remainders what the quotient does not say.
    quotient = min(choices, key=lambda q: (1 << (q - range_bits)) / 8 + size * (64 - q) / 8)
    slots = 1 << (quotient - range_bits)
    slot = (upper >> np.uint64(64 - quotient) & np.uint64(slots - 1)).astype(np.int64)
    # In unary: a one for each key of a slot, then a zero.
    runs = np.zeros(slots + size, np.uint8)
    runs[slot + np.arange(size)] = 1
    parts = upper.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :(64 - quotient) // 8].tobytes()
    if words > 2:
        parts += lower.astype("<u8" if words == 4 else "<u4").tobytes()
    large = np.flatnonzero(counts >= 255)
    prefix = int(upper[0] >> np.uint64(64 - range_bits)) if size and range_bits else 0
    return b"".join((HEAD.pack(words, quotient, prefix, size, len(large)), np.packbits(runs).tobytes(), parts,
                     np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()))


def decode(data: bytes, range_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The keys of a filter (upper, lower), their counts, and the words of a key."""
    words, quotient, prefix, size, large = HEAD.unpack_from(data)
    slots, at = 1 << (quotient - range_bits), HEAD.size
    packed = -(-(slots + size) // 8)
    runs = np.unpackbits(np.frombuffer(data, np.uint8, packed, at))[:slots + size]
    at += packed
    place = np.flatnonzero(runs)
    slot = (place - np.arange(size)).astype(np.uint64)
    width = (64 - quotient) // 8
    upper = np.zeros((size, 8), np.uint8)
    upper[:, :width] = np.frombuffer(data, np.uint8, size * width, at).reshape(size, width)
    at += size * width
    upper = upper.view("<u8").ravel() | slot << np.uint64(64 - quotient)
    if range_bits:
        upper |= np.uint64(prefix) << np.uint64(64 - range_bits)
    lower = np.zeros(size, np.uint64)
    if words > 2:
        kind = "<u8" if words == 4 else "<u4"
        lower = np.frombuffer(data, kind, size, at).astype(np.uint64)
        at += size * np.dtype(kind).itemsize
    counts = np.frombuffer(data, np.uint8, size, at).astype(np.int64)
    if large:
        counts[counts == 255] = np.frombuffer(data, "<i8", large, at + size)
    return upper, lower, counts, words


def cut(upper: np.ndarray, lower: np.ndarray, counts: np.ndarray, words: int, range_bits: int) -> list[tuple[int, bytes]]:
    """(range, filter) of ascending distinct keys, for each range that has any."""
    if not len(upper):
        return []
    place = (upper >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(upper), np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    ends = [*first[1:], len(place)]
    return [(int(place[a]), encode(upper[a:b], lower[a:b], counts[a:b], words, range_bits))
            for a, b in zip(first, ends, strict=True)]


def merge(filters: Sequence[bytes], range_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All keys of filters of one range and one length of n-grams, with their counts added up."""
    parts = [decode(f, range_bits) for f in filters]
    upper, lower, counts = (np.concatenate([p[n] for p in parts]) for n in range(3))
    return *summed(upper, lower, counts), parts[0][3]
