"""Re-Pair grammars of id sequences, on numpy arrays.

In each round the most frequent pairs of neighbouring symbols become nonterminals, a batch at a time, until no pair stands
``LEAST`` times. No pair crosses the end of a document, so every document is a slice of symbols that decodes alone.
"""

from __future__ import annotations

import numpy as np

PAIRS_PER_ROUND, LEAST = 1800, 12
_BITS, _STRETCH = 20, 1 << 14


def _slots(s: np.ndarray, room: np.ndarray) -> np.ndarray:
    """A hash of each symbol and its successor, wrapping in 32 bits; ``_BITS`` of them stay. Fills ``room``, a stretch that fits the cache at a time."""
    slot = room[: len(s) - 1]
    for i in range(0, len(slot), _STRETCH):
        j = min(i + _STRETCH, len(slot))
        mixed = s[i:j] * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        mixed += s[i + 1 : j + 1]
        mixed *= np.uint32(0x85EBCA77)
        mixed >>= np.uint32(32 - _BITS)
        slot[i:j] = mixed
    return slot


def _exact(s: np.ndarray, maybe: np.ndarray, least: int):
    """(places, pair of each, left, right) of the pairs that stand ``least`` times among ``maybe``, which hold all their places."""
    key = (s[maybe].astype(np.uint64) << np.uint64(32)) | s[maybe + 1]
    pairs, which, n = np.unique(key, return_inverse=True, return_counts=True)
    rank = np.cumsum(n >= least) - 1
    hit = (n >= least)[which]
    pairs = pairs[n >= least]
    return maybe[hit], rank[which[hit]], (pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32)


def _by_slots(s: np.ndarray, ends: np.ndarray, batch: int, least: int, room: np.ndarray):
    """As ``_exact`` for about ``batch`` most frequent pairs, and whether all frequent pairs were seen.

    Each of the most frequent slots puts the pair at its last place forward. When few slots are left, all their pairs are counted.
    """
    slot = _slots(s, room)
    slot[ends[:-1]] = 1 << _BITS  # no pair crosses the end of a document
    counts = np.bincount(slot, minlength=(1 << _BITS) + 1)[: 1 << _BITS]
    top = np.flatnonzero(counts >= least)
    every = len(top) <= batch
    if not every:
        top = top[np.argpartition(counts[top], -batch)[-batch:]]
    table = np.full((1 << _BITS) + 1, -1, np.int32)
    table[top] = np.arange(len(top), dtype=np.int32)
    rank = table.take(slot)
    maybe = np.flatnonzero(rank >= 0)
    if every:
        return *_exact(s, maybe, least), True
    rank, left, right = rank[maybe], s[maybe], s[maybe + 1]
    shown = np.zeros(len(top), np.intp)
    shown[rank] = np.arange(len(maybe))
    same = (left == left[shown][rank]) & (right == right[shown][rank])
    n = np.bincount(rank[same], minlength=len(top))
    winners = n >= least
    if not winners.any():  # the slots put rare pairs forward only: count all pairs
        return *_exact(s, np.flatnonzero(~ends[:-1]), least), True
    hit = same & winners[rank]
    number = np.cumsum(winners) - 1
    return maybe[hit], number[rank[hit]], left[shown[winners]], right[shown[winners]], False


def compress(ids: np.ndarray, ends: np.ndarray, terminals: int, batch: int = PAIRS_PER_ROUND, least: int = LEAST):
    """(symbols, ends, rules, lengths): rules (k, 2) give nonterminal ``terminals + i``; lengths its number of ids.

    ``ends`` marks each document's last id, and on return its last symbol. Once a round has replaced all frequent pairs, only pairs
    with one of its nonterminals can become frequent, so the next round counts beside those alone.
    """
    s, rules, total, fresh = ids.astype(np.uint32), [], terminals, None
    room = np.empty(len(s), np.intp)
    while len(s) > 1:
        if fresh is None:
            at, rank, left, right, every = _by_slots(s, ends, batch, least, room)
        else:
            new = s >= fresh
            at, rank, left, right = _exact(s, np.flatnonzero((new[:-1] | new[1:]) & ~ends[:-1]), least)
            every = True
        if not len(at):
            break
        # of places that overlap, every other one from the left of its run
        head = np.ones(len(at), bool)
        head[1:] = np.diff(at) > 1
        first = np.flatnonzero(head)
        inside = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        take = inside % 2 == 0
        at, rank = at[take], rank[take]
        s[at] = total + rank
        ends = ends.copy()
        ends[at] = ends[at + 1]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        keep = np.flatnonzero(keep)
        s, ends = s.take(keep), ends.take(keep)
        rules.append(np.stack([left, right], 1))
        fresh = total if every else None
        total += len(left)
    rules = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return s, ends, rules, _lengths(rules, terminals)


def _lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    size = np.ones(len(rules), np.int64)
    for _ in range(len(rules)):  # rules refer to earlier rounds only, so this ends after as many steps as rounds
        both = [np.where(side >= terminals, size[np.maximum(side.astype(np.int64) - terminals, 0)], 1) for side in (rules[:, 0], rules[:, 1])]
        new = both[0] + both[1]
        if (new == size).all():
            break
        size = new
    return size.astype(np.uint32)


def _gather(flat: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    begin = np.cumsum(lengths) - lengths
    return flat[np.repeat(firsts - begin, lengths) + np.arange(int(lengths.sum()))]


def expansions(rules: np.ndarray, lengths: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray]:
    """All nonterminals' ids in one array, and where each begins; filled from the shortest up."""
    lengths = lengths.astype(np.int64)
    firsts = np.cumsum(lengths) - lengths
    flat = np.zeros(int(lengths.sum()), np.uint32)
    depth = np.zeros(len(rules), np.int64)
    for _ in range(len(rules)):
        sides = [np.where(x >= terminals, depth[np.maximum(x.astype(np.int64) - terminals, 0)], 0) for x in rules.T]
        new = np.maximum(*sides) + 1
        if (new == depth).all():
            break
        depth = new
    for level in range(1, int(depth.max(initial=0)) + 1):
        own = np.flatnonzero(depth == level)
        at = firsts[own].copy()
        for side in (0, 1):
            x = rules[own, side].astype(np.int64)
            leaf = x < terminals
            flat[at[leaf]] = x[leaf]
            inner = ~leaf
            k = x[inner] - terminals
            size = lengths[k]
            begin = np.cumsum(size) - size
            step = np.arange(int(size.sum())) - np.repeat(begin, size)
            flat[np.repeat(at[inner], size) + step] = flat[np.repeat(firsts[k], size) + step]
            grown = np.ones(len(own), np.int64)
            grown[inner] = size
            at += grown
    return flat, firsts


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that ``symbols`` stand for; any slice of a block's symbols can be given."""
    flat, firsts = expansions(rules, lengths, terminals)
    table = np.concatenate([np.arange(terminals, dtype=np.uint32), flat])
    starts = np.concatenate([np.arange(terminals), terminals + firsts])
    sizes = np.concatenate([np.ones(terminals, np.int64), lengths.astype(np.int64)])
    return _gather(table, starts[symbols], sizes[symbols])
