"""Suffix order of chosen starts, one bucket at a time, by difference-cover ranks.

The starts of a text are cut into buckets by their first bytes, and one bucket
at a time is sorted by its first PERIOD bytes.  Starts that agree on all of
them are resolved without reading on: for any two starts some shift below
PERIOD puts both on sample positions (a difference cover), whose ranks were
computed beforehand.  So the memory beside the text is the ranks of the sample
and one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PERIOD, STEP = 64, 8
#: 0 to 7 and the multiples of 8: any difference mod 64 is one between two of them.
COVER = np.unique(np.concatenate([np.arange(STEP), np.arange(0, PERIOD, STEP)]))
#: Starts in a bucket, unless more agree on their first 8 bytes.
BUCKET = 1 << 15


def _shifts() -> np.ndarray:
    """The least shift that puts positions of residues (i, j) on the cover."""
    member = np.zeros(PERIOD, bool)
    member[COVER] = True
    r = np.arange(PERIOD)
    on = member[(r[:, None] + r[None, :]) % PERIOD]
    return (on[:, None, :] & on[None, :, :]).argmax(axis=2)


SHIFTS = _shifts()


class Text:
    """Bytes with 8-byte words readable at any position."""

    def __init__(self, data: bytes):
        self.size = len(data)
        raw = np.frombuffer(data + bytes(4 * PERIOD), np.uint8)
        self.words = np.lib.stride_tricks.as_strided(
            np.frombuffer(raw, ">u8", len(raw) // 8), (len(raw) - 8,), (1,)
        )

    def word(self, positions: np.ndarray) -> np.ndarray:
        return self.words[positions].astype(np.uint64)


def _order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by the keys, first key first, and marks of rows that differ from the one before."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
    return order, new


def sample_ranks(text: Text) -> np.ndarray:
    """Ranks of all suffixes that start on the cover; -1 elsewhere."""
    size = text.size
    at = (np.arange(-(-size // PERIOD))[:, None] * PERIOD + COVER[None, :]).ravel()
    at = at[at < size]
    rank = np.full(size + 2 * PERIOD, -1, np.int64)
    order, new = _order([text.word(at + 8 * i) for i in range(PERIOD // 8)])
    rank[at[order]] = np.cumsum(new)
    known = PERIOD
    # Doubled until no two are alike, so that comparisons at different shifts agree.
    while not new.all() and known < 2 * size:
        # A position one length further is on the cover too; beyond the end all are alike.
        further = np.where(at + known < len(rank), rank[np.minimum(at + known, len(rank) - 1)], 0)
        key = rank[at] << 32 | np.maximum(further, 0)
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at[order]] = np.cumsum(new)
        known *= 2
    return rank


def _resolve(starts: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Sort starts within groups of equal first PERIOD bytes by sample ranks.

    Starts of one residue share their shift, so a group of one residue is
    sorted by the ranks there.  Groups of several residues are merged.
    """
    residue = starts % PERIOD
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(begin, len(group)))
    alike = np.repeat(np.maximum.reduceat(residue, begin) == np.minimum.reduceat(residue, begin), size)
    out = starts.copy()
    own = starts[alike]
    out[alike] = own[np.lexsort((rank[own + SHIFTS[residue[alike], residue[alike]]], group[alike]))]
    if not alike.all():
        out[~alike] = _merge(starts[~alike], group[~alike], rank)
    return out


def _merge(starts: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Sort within groups by comparing pairs at the shift of their residues.

    All groups are merged at once, level by level: every start finds its place
    among the sibling run by a binary search.
    """
    n = len(starts)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(begin, n))
    first, length = np.repeat(begin, size), np.repeat(size, size)
    place = np.arange(n) - first
    width = 1
    while width < size.max(initial=1):
        left = (place // (2 * width)) * 2 * width
        in_left = place < left + width
        low = np.where(in_left, np.minimum(left + width, length), left)
        high = np.where(in_left, np.minimum(left + 2 * width, length), left + width)
        base = low.copy()
        own = starts[first + place]
        while True:
            open_ = low < high
            if not open_.any():
                break
            mid = (low + high) // 2
            other = starts[np.minimum(first + mid, n - 1)]
            shift = SHIFTS[other % PERIOD, own % PERIOD]
            a, b = rank[other + shift], rank[own + shift]
            # Equal ones keep their order: those of the left run come first.
            before = (a < b) | (~in_left & (a == b))
            low = np.where(open_ & before, mid + 1, low)
            high = np.where(open_ & ~before, mid, high)
        moved = left + (place - np.where(in_left, left, left + width)) + (low - base)
        out = np.empty_like(starts)
        out[first + moved] = own
        starts = out
        width *= 2
    return starts


def buckets(text: Text, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts in suffix order, group of equal first PERIOD bytes), bucket after bucket."""
    if not len(starts):
        return
    rank = sample_ranks(text)
    head = text.word(starts)
    order = np.argsort(head, kind="stable")
    starts, head = starts[order], head[order]
    new = np.concatenate([[True], head[1:] != head[:-1]])
    edges = np.flatnonzero(new)
    # The first edge at or behind every multiple of BUCKET.
    cuts = np.unique(np.append(edges[np.minimum(np.searchsorted(edges, np.arange(0, len(starts), BUCKET)), len(edges) - 1)], len(starts)))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        some = starts[lo:hi]
        order, new = _order([text.word(some + 8 * i) for i in range(PERIOD // 8)])
        some, group = some[order], np.cumsum(new)
        tied = np.zeros(len(some), bool)
        same = ~new[1:]
        tied[1:] |= same
        tied[:-1] |= same
        if tied.any():
            some = some.copy()
            some[tied] = _resolve(some[tied], group[tied], rank)
        yield some, group


def repeated(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Marks of the starts whose `length` bytes another start shares.

    Starts with equal bytes are neighbours in suffix order; neighbours are
    compared byte by byte.  Every start has `length` bytes before the end.
    """
    text = Text(data)
    out = np.zeros(len(starts), bool)
    where = np.argsort(starts, kind="stable")
    by_start = starts[where]
    last: np.ndarray | None = None
    for some, _ in buckets(text, by_start):
        if last is not None:
            some = np.concatenate([last, some])
        a, b = some[:-1], some[1:]
        alike = np.arange(len(a))
        for at in [*range(0, length - 8, 8), length - 8]:
            alike = alike[text.words[a[alike] + at] == text.words[b[alike] + at]]
            if not len(alike):
                break
        for p in (a[alike], b[alike]):
            out[where[np.searchsorted(by_start, p)]] = True
        last = some[-1:]
    return out
