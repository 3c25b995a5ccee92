"""Suffix sorting by recursive induction with queues that spill to disk.

A suffix is L if it is greater than the next one, else S; an S suffix after an
L suffix is a star. The stars' substrings (from one star to the next) are named by rank, the string of
the names is sorted by recursion unless all names differ, and the order of the
stars induces all others: going up through the first symbols, every suffix
taken from the queue sends the suffix before it, if that is L, to the queue of
its first symbol; then going down for the S suffixes. A queue hands out ranges
of first symbols in turn, so it is a priority queue of runs: what is sent to
a range stays in the order it came, and is kept in files beyond a number of
items. A step takes a whole range; where the names are many, a range holds
many symbols, and suffixes that follow each other inside it are ordered by
doubling the distance looked ahead. A string of a few ten thousand names, where recursion ends up, is sorted by such
doubling as a whole: a pass through its ranges would cost more than the names do.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_ITEMS = 1 << 24
RANGES = 256
# Suffixes that a range of many symbols has at least, and the longest string sorted without a recursion.
RANGE_ITEMS, DOUBLED = 1 << 12, 1 << 16


class RunQueue:
    """Runs of positions for each range, in the order they came; held in files beyond ``memory`` positions."""

    def __init__(self, ranges: int, memory: int = MEMORY_ITEMS):
        self.runs: list[list] = [[] for _ in range(ranges)]
        self.memory, self.held = memory, 0
        self.file = None

    def push(self, at: int, positions: np.ndarray) -> None:
        if not len(positions):
            return
        if self.held + len(positions) > self.memory:
            self.spill()
        self.runs[at].append(positions)
        self.held += len(positions)

    def spill(self) -> None:
        """Move all runs in memory to the end of the file; their places stay in the lists."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.runs:
            for number, run in enumerate(runs):
                if isinstance(run, np.ndarray):
                    runs[number] = (self.file.tell(), len(run))
                    self.file.write(run.astype(np.int64).tobytes())
        self.held = 0

    def pop(self, at: int) -> np.ndarray:
        parts = [np.zeros(0, np.int64)]
        for run in self.runs[at]:
            if isinstance(run, np.ndarray):
                self.held -= len(run)
                parts.append(run)
            else:
                self.file.seek(run[0])
                parts.append(np.frombuffer(self.file.read(8 * run[1]), np.int64))
        self.runs[at] = []
        return np.concatenate(parts)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is S; the end of the text is below every symbol."""
    step = np.sign(np.diff(text.astype(np.int64), append=-1))
    place = np.where(step != 0, np.arange(len(text)), len(text))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return step[following] > 0


def _runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by small keys, and where each present key starts in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))


def _name(text: np.ndarray, is_s: np.ndarray, stars: np.ndarray) -> np.ndarray:
    """Dense ranks of the star substrings, from each star up to the next one or the end."""
    ends = np.append(stars[1:] + 1, len(text) + 1)
    symbols = np.append(2 * text.astype(np.uint64) + is_s.astype(np.uint64) + np.uint64(2), np.uint64(1))
    bits = int(symbols.max()).bit_length()
    width = max(min(64 // bits, 8), 1)
    words = symbols.copy()
    for ahead in range(1, width):  # the symbols of a word, each in its bits
        words <<= np.uint64(bits)
        words[:-ahead] |= symbols[ahead:]
    group = np.zeros(len(stars), np.int64)
    active, offset = np.arange(len(stars)), 0
    while len(active):
        at = stars[active] + offset
        word = words[np.minimum(at, len(text))].copy()
        left = np.clip(ends[active] - at, 0, width)
        word &= ~np.uint64(0) << (np.uint64(bits) * (width - left).astype(np.uint64))  # nothing after its end
        word[left == 0] = 0
        order = np.lexsort((word, group[active]))
        active, word, left = active[order], word[order], left[order]
        old = group[active]
        first = np.concatenate([[True], old[1:] != old[:-1]])
        new = first | np.concatenate([[True], word[1:] != word[:-1]])
        place = np.arange(len(active))
        start = np.maximum.accumulate(np.where(first, place, 0))
        group[active] = old + np.maximum.accumulate(np.where(new, place, 0)) - start
        alone = new & np.append(new[1:], True)
        active = active[~alone & (left == width)]
        active.sort()
        offset += width
    return np.unique(group, return_inverse=True)[1]


def _range_order(text, items, seeds, members, place_of):
    """Order the positions of a range by (first symbol, own kind before seeds, order of the next position).

    ``items`` come in the order of their next positions, which are below the range, ``seeds`` in their own; the next position of
    every other member is in the range.
    """
    fixed = len(items) + len(seeds)
    every = np.concatenate([items, seeds, members])
    kind = np.zeros(len(every), np.int64)
    kind[len(items):fixed] = 1
    order_in = np.concatenate([np.arange(fixed), np.full(len(members), fixed)])
    order = np.lexsort((order_in, kind, text[every]))
    same = np.concatenate([[False], (text[every[order[1:]]] == text[every[order[:-1]]])
                           & (kind[order[1:]] == kind[order[:-1]]) & (order_in[order[1:]] == order_in[order[:-1]])])
    rank = np.empty(len(every), np.int64)
    rank[order] = np.maximum.accumulate(np.where(same, 0, np.arange(len(every))))
    if not same.any():
        return every[order]
    place_of[every] = np.arange(len(every))
    ahead = np.arange(len(every))
    ahead[fixed:] = place_of[members + 1]
    while True:
        order = np.lexsort((rank[ahead], rank))
        pair = rank[order], rank[ahead][order]
        same = np.concatenate([[False], (pair[0][1:] == pair[0][:-1]) & (pair[1][1:] == pair[1][:-1])])
        rank = np.empty(len(every), np.int64)
        rank[order] = np.maximum.accumulate(np.where(same, 0, np.arange(len(every))))
        if not same.any():
            return every[order]
        ahead = ahead[ahead]


def _induce(text: np.ndarray, wanted: np.ndarray, seeds: np.ndarray, range_of: np.ndarray, ranges: int,
            first: np.ndarray, single: bool, memory: int) -> list[np.ndarray]:
    """All ``wanted`` suffixes, a list for each range, from sorted ``seeds``; going up.

    ``first`` are the wanted suffixes known at the start, before everything.
    """
    queue, out = RunQueue(ranges, memory), []
    seed_order, starts = _runs_of(range_of[seeds]) if len(seeds) else (np.zeros(0, int), np.zeros(0, int))
    seeds_in = {int(range_of[seeds[part[0]]]): seeds[part] for part in np.split(seed_order, starts[1:]) if len(part)}
    for position in first:
        queue.push(int(range_of[position]), np.array([position]))
    place_of = None if single else np.zeros(len(text), np.int64)
    for here in range(ranges):
        items, own_seeds = queue.pop(here), seeds_in.get(here, np.zeros(0, np.int64))
        inside, frontier = [], items if single else np.concatenate([items, own_seeds])
        while len(frontier):
            before = frontier[frontier > 0] - 1
            before = before[wanted[before]]
            frontier = before[range_of[before] == here]
            inside.append(frontier)
        members = np.concatenate([np.zeros(0, np.int64), *inside])
        if single:  # one symbol: what came later is greater
            mine = np.concatenate([items, members])
            scanned = np.concatenate([mine, own_seeds])
        else:
            scanned = _range_order(text, items, own_seeds, members, place_of)
            mine = scanned[wanted[scanned]]
        out.append(mine)
        before = scanned[scanned > 0] - 1
        before = before[wanted[before] & (range_of[before] != here)]
        if len(before):
            target = range_of[before]
            order, starts = _runs_of(target)
            dealt, cuts = before[order], [*starts.tolist(), len(order)]
            for at, begin, end in zip(target[order[starts]].tolist(), cuts[:-1], cuts[1:], strict=True):
                queue.push(at, dealt[begin:end])
    queue.close()
    return out


def doubled(text: np.ndarray) -> np.ndarray:
    """The suffix array of a short string: ranks by 1, 2, 4... symbols until all differ."""
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        ahead = np.zeros(len(rank), np.int64)  # nothing is below every rank
        ahead[:-step or None] = rank[step:]
        key = rank * (len(rank) + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], np.diff(key[order]) != 0])
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        step *= 2


def suffix_array(text: np.ndarray, memory: int = MEMORY_ITEMS, short: int = 0) -> np.ndarray:
    """Positions of the suffixes of a string of numbers from 0 on, in ascending order; a prefix comes first.

    Strings of names of at most ``short`` symbols are sorted by doubling.
    """
    size = len(text)
    if size < 2:
        return np.arange(size)
    if size <= short:
        return doubled(text)
    is_s = suffix_types(text)
    stars = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(stars):
        names = _name(text, is_s, stars)
        distinct = int(names.max()) + 1
        ordered = np.argsort(names) if distinct == len(stars) else suffix_array(names, memory, short)
        stars = stars[ordered]
    top = int(text.max())
    single = top < RANGES + 2
    if single:
        range_of, ranges = text.astype(np.uint16), top + 1
    else:  # about as many suffixes in each range
        counts = np.cumsum(np.bincount(text))
        wanted = min(RANGES, max(size // RANGE_ITEMS, 2)) if short else RANGES
        range_of = (counts * wanted // (counts[-1] + 1)).astype(np.uint16)[text]
        ranges = int(range_of.max()) + 1
    lower = _induce(text, ~is_s, stars, range_of, ranges, np.array([size - 1]), single, memory)
    # Downwards is upwards with the symbols and the order of the seeds turned round.
    turned = (ranges - 1 - range_of.astype(np.int64)).astype(np.uint16)
    seeds = np.concatenate(lower)[::-1]
    upper = _induce(top - text.astype(np.int64), is_s, seeds, turned, ranges, np.zeros(0, np.int64), single, memory)
    if single:
        return np.concatenate([part for low, high in zip(lower, reversed(upper), strict=True) for part in (low, high[::-1])])
    merged = []
    for low, high in zip(lower, reversed(upper), strict=True):
        both = np.concatenate([low, high[::-1]])
        merged.append(both[np.argsort(text[both], kind="stable")])
    return np.concatenate(merged)


def common_prefixes(data: np.ndarray, order: np.ndarray, room: np.ndarray, longest: int) -> np.ndarray:
    """Common bytes of each suffix with the one before it in order, up to ``longest`` and to the end of its own row.

    ``room`` is the number of bytes from a position to the end of its row. Eight bytes are compared at a time, and only
    the pairs still equal go on.
    """
    words = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    for span in (1, 2, 4):
        words = words[:-span] | words[span:] << np.uint64(8 * span)
    limit = np.minimum(np.minimum(room[order[1:]], room[order[:-1]]), longest)
    common = np.zeros(len(order), np.int64)
    live = np.flatnonzero(limit > 0)
    for offset in range(0, longest, 8):
        differ = words[np.minimum(order[live + 1] + offset, len(data))] ^ words[
            np.minimum(order[live] + offset, len(data))]
        ended = (differ != 0) | (limit[live] <= offset + 8)
        lowest = differ[ended] & (~differ[ended] + np.uint64(1))
        equal = np.where(lowest == 0, 8, np.frexp(np.maximum(lowest, 1).astype(np.float64))[1].astype(int) - 1 >> 3)
        done = live[ended]
        common[done + 1] = np.minimum(offset + equal, limit[done])
        live = live[~ended]
        if not len(live):
            break
    return common
