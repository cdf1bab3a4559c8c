"""Longest common extensions inside integer sequences by recompression.

The sequence is rewritten level by level. A block level replaces every maximal
stretch of one symbol by a symbol for (symbol, length); a pair level splits the
alphabet into left and right symbols and replaces every left-right neighbour
pair by a symbol for the pair. Equal stretches are rewritten alike but for
their edges, so the levels are a run-length grammar in which two places are
compared from symbol to symbol: up while the enclosing symbols start together
and are equal, sideways over equal symbols, down where they differ. All
queries take such a step together, as array operations.

Levels end where no symbol occurs twice. Levels take some 70 bytes per element.
"""

from __future__ import annotations

import numpy as np

#: Alphabet splits that are tried at a pair level; the one that makes most pairs is taken.
SPLITS = 4
_ODD = 0x9E3779B97F4A7C15


def _rename(keys: np.ndarray, first_name: int) -> tuple[np.ndarray, int]:
    """Equal keys get equal names from ``first_name`` on; also the next free name."""
    values, names = np.unique(keys, return_inverse=True)
    return names + first_name, first_name + len(values)


def _block_level(sym: np.ndarray, free: int):
    """(symbols, first child, next free name) with every stretch of one symbol as one symbol."""
    starts = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))
    lengths = np.diff(starts, append=len(sym))
    out = sym[starts]
    many = np.flatnonzero(lengths > 1)
    out[many], free = _rename(out[many] * np.int64(lengths.max() + 1) + lengths[many], free)
    return out, starts, free


def _pair_level(sym: np.ndarray, free: int, level: int):
    """(symbols, first child, next free name) with every left-right pair as one symbol."""
    best = None
    for split in range(SPLITS):
        odd = np.uint64(_ODD * (2 * (level * SPLITS + split) + 1) % 2 ** 64)
        left = ((sym.astype(np.uint64) + odd) * odd >> np.uint64(40)) & np.uint64(1) == 1
        pairs = left[:-1] & ~left[1:]
        n = np.count_nonzero(pairs)
        if best is None or n > best[0]:
            best = n, pairs
    pairs = np.concatenate([best[1], [False]])
    second = np.concatenate([[False], pairs[:-1]])
    starts = np.flatnonzero(~second)
    out = sym[starts]
    own = np.flatnonzero(pairs[starts])
    at = starts[own]
    out[own], free = _rename(sym[at] * np.int64(free) + sym[at + 1], free)
    return out, starts, free


class Grammar:
    """Levels over ``sequence`` (non-negative integers). Its first and last elements must
    occur nowhere else: no extension gets past them."""

    def __init__(self, sequence: np.ndarray):
        sym = sequence.astype(np.int64)
        free = int(sym.max()) + 1 if len(sym) else 1
        levels, firsts, blocks = [sym], [], []
        while True:
            if not (np.bincount(sym)[sym] > 1).any():
                break
            if (sym[1:] == sym[:-1]).any():
                out, starts, free = _block_level(sym, free)
                blocks.append(True)
            else:
                out, starts, free = _pair_level(sym, free, len(blocks))
                blocks.append(False)
            # Names are made dense again, so that products of two names stay in 64 bits.
            _, sym = np.unique(out, return_inverse=True)
            free = int(sym.max()) + 1
            levels.append(sym)
            firsts.append(starts)
        self._lay_out(levels, firsts, blocks)

    def _lay_out(self, levels, firsts, blocks) -> None:
        """One flat array per property: symbol, parent (-1 on the top level), first and
        last child, and whether the element's parent is a block."""
        base = np.cumsum([0, *map(len, levels)])
        n = int(base[-1])
        self.sym = np.concatenate(levels).astype(np.int32)
        self.up = np.full(n, -1, np.int32)
        self.first, self.last = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.in_block = np.zeros(n, bool)
        for k, (starts, block) in enumerate(zip(firsts, blocks)):
            size = len(levels[k])
            sizes = np.diff(starts, append=size)
            self.up[base[k]:base[k + 1]] = base[k + 1] + np.repeat(np.arange(len(starts)), sizes)
            self.first[base[k + 1]:base[k + 2]] = base[k] + starts
            self.last[base[k + 1]:base[k + 2]] = base[k] + starts + sizes - 1
            self.in_block[base[k]:base[k + 1]] = block
        self.ground = len(levels[0])

    def _step(self, a: np.ndarray, b: np.ndarray, edge: np.ndarray, far: np.ndarray, sign: int):
        """One step of cursors on equal symbols: to their parents where both cursors stand
        on the near edge and the parents are equal, else past the symbols."""
        ua, ub = self.up[a], self.up[b]
        rise = (ua >= 0) & (edge[ua] == a) & (edge[ub] == b) & (self.sym[ua] == self.sym[ub])
        # In a block all remaining symbols are equal: the shorter rest is passed at once.
        rest = np.where(self.in_block[a], np.minimum(sign * (far[ua] - a), sign * (far[ub] - b)), 0) + 1
        return np.where(rise, ua, a + sign * rest), np.where(rise, ub, b + sign * rest)

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """How far the places ``i`` move (right, or left if not ``forward``) in step with
        ``j`` until the sequence differs; i < j."""
        edge, far, sign = (self.first, self.last, 1) if forward else (self.last, self.first, -1)
        a, b = i.astype(np.int64), j.astype(np.int64)
        live = np.arange(len(a))
        end = np.zeros(len(a), np.int64)
        while len(live):
            same = self.sym[a] == self.sym[b]
            done = ~same & (a < self.ground)
            if done.any():
                end[live[done]] = a[done]
                keep = ~done
                live, a, b, same = live[keep], a[keep], b[keep], same[keep]
            sa, sb = self._step(a, b, edge, far, sign)
            a, b = np.where(same, sa, edge[a]), np.where(same, sb, edge[b])
        return sign * (end - i)
