"""Signature trees over token sets, and the links that a dual traversal of one finds.

A set's signature is a bitmap with one bit per token, by hash. A node holds the OR of its children's bitmaps, the range of
their sizes and the most tokens any of them loses to shared bits. Two sets can have no more tokens in common than their
bitmaps have bits in common, and the lesser loss on top; so a pair of nodes can be dropped, with all pairs below it, when
that is less than any two of its sets would need. Nothing else drops a pair but that its sets are in one component already.
"""

from __future__ import annotations

import numpy as np

FAN = 4
PAIRS_AT_A_TIME = 8192


class Groups:
    """Union-find over small numbers."""

    def __init__(self, of: np.ndarray):
        """``of``: the component each number is in to begin with."""
        first: dict[int, int] = {}
        self.parent = [first.setdefault(int(c), i) for i, c in enumerate(of)]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i


def signature(tokens: np.ndarray, bits: int | None = None) -> np.ndarray:
    """The bitmap of a set, as 64-bit words; by default four bits or more per token, within limits."""
    bits = bits or 1 << int(np.clip(int(4 * len(tokens) - 1).bit_length(), 9, 16))
    bitmap = np.zeros(bits, np.uint8)
    bitmap[(tokens % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(bitmap, bitorder="little").view(np.uint64)


def folded(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of different sizes at the smallest of them."""
    words = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, words), axis=0) for m in maps])


def windows(size: np.ndarray, percent: int):
    """Groups of sets whose sizes are alike; every two that are not too different for a link are in one of them."""
    octave = np.frexp(np.maximum(size, 1))[1]
    for k in np.unique(octave):
        inside = np.flatnonzero((octave >= k) & (percent * size < 100 * (1 << int(k))))
        if len(inside) > 1 and (octave[inside] == k).any():
            yield inside


def depth(sets: int) -> int:
    """How many levels a tree of so many sets has."""
    levels = 1
    while sets > FAN:
        sets, levels = -(-sets // FAN), levels + 1
    return levels


class Tree:
    """Signatures of sets in the order given, level by level; similar sets should be neighbours."""

    def __init__(self, maps: np.ndarray, size: np.ndarray, component: np.ndarray, depth: int = 0):
        lost = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, size, size, lost, component, component)]
        while len(self.levels[-1][0]) > FAN or len(self.levels) < depth:
            maps, least, most, lost, low, high = self.levels[-1]
            at = np.arange(0, len(maps), FAN)
            self.levels.append((
                np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
                np.maximum.reduceat(lost, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))


def _kept(one: tuple, two: tuple, a: np.ndarray, b: np.ndarray, percent: int, leaves: bool) -> np.ndarray:
    """Which pairs of nodes, of the same level of one tree or two, may hold two sets that link and are in different
    components."""
    maps, least, most, lost, low, high = one
    maps2, least2, most2, lost2, low2, high2 = two
    greater = np.maximum(least[a], least2[b])
    # of two linked sets the smaller has at least so many percent of the greater's tokens
    fine = 100 * np.minimum(most[a], most2[b]) >= percent * greater
    fine &= ~((low[a] == high[a]) & (low2[b] == high2[b]) & (low[a] == low2[b]))
    at = np.flatnonzero(fine)
    common = np.bitwise_count(maps[a[at]] & maps2[b[at]]).sum(axis=1, dtype=np.int64) + np.minimum(lost[a[at]], lost2[b[at]])
    need = percent * (least[a[at]] + least2[b[at]]) if leaves else (100 + percent) * percent * greater[at] // 100
    fine[at] = (100 + percent) * common >= need
    return fine


def candidates(one: Tree, percent: int, two: Tree | None = None):
    """Pairs of sets that no bound excludes, some at a time: of one tree, or of two of the same depth."""
    top, same = len(one.levels) - 1, two is None
    two = two or one
    x, y = np.arange(len(one.levels[top][0])), np.arange(len(two.levels[top][0]))
    a, b = np.triu_indices(len(x)) if same else (np.repeat(x, len(y)), np.tile(y, len(x)))
    stack, child = [(top, a, b)], np.arange(FAN)
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS_AT_A_TIME:
            stack.append((level, a[PAIRS_AT_A_TIME:], b[PAIRS_AT_A_TIME:]))
            a, b = a[:PAIRS_AT_A_TIME], b[:PAIRS_AT_A_TIME]
        fine = _kept(one.levels[level], two.levels[level], a, b, percent, level == 0)
        a, b = a[fine], b[fine]
        if not len(a):
            continue
        if level == 0:
            yield a, b
            continue
        x = np.repeat(a * FAN, FAN * FAN) + np.tile(np.repeat(child, FAN), len(a))
        y = np.repeat(b * FAN, FAN * FAN) + np.tile(np.tile(child, FAN), len(b))
        fine = (x < len(one.levels[level - 1][0])) & (y < len(two.levels[level - 1][0]))
        if same:
            fine &= x <= y if level > 1 else x < y
        stack.append((level - 1, x[fine], y[fine]))


def links(sets: list[np.ndarray], component: np.ndarray, percent: int, asks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets with Jaccard similarity of ``percent`` or more, enough of them to join all that such pairs and the
    given components connect; none within a component. Empty sets link with nothing. With ``asks`` only pairs count of
    which exactly one asks."""
    size, component = np.array([len(s) for s in sets], np.int64), np.asarray(component)
    groups, members, out = Groups(component), {}, []
    root = groups.root

    def tokens(i: int) -> frozenset:
        if i not in members:
            members[i] = frozenset(sets[i].tolist())
        return members[i]

    for inside in windows(size, percent):
        inside = inside[size[inside] > 0]
        parts = [inside] if asks is None else [inside[asks[inside]], inside[~asks[inside]]]
        if len(inside) < 2 or not min(map(len, parts)):
            continue
        bits = 1 << int(np.clip(np.ceil(np.log2(4 * np.median(size[inside]) + 1)), 9, 14))
        made = [np.stack([signature(sets[i], bits) for i in part]) for part in parts]
        trees = [Tree(m, size[part], component[part], depth(max(map(len, parts)))) for m, part in zip(made, parts)]
        for a, b in candidates(trees[0], percent, *trees[1:]):
            for i, j in zip(parts[0][a].tolist(), parts[-1][b].tolist()):
                if i == j:
                    continue
                x, y = root(i), root(j)
                if x == y:
                    continue
                s, t = tokens(i), tokens(j)
                common = len(s & t)
                if 100 * common >= percent * (len(s) + len(t) - common):
                    groups.parent[max(x, y)] = min(x, y)
                    out.append((i, j))
    return out


def may_link(maps: list[np.ndarray], size: np.ndarray, component: np.ndarray, percent: int, asks: np.ndarray | None = None):
    """Pairs of sets of different components that no bound keeps from a link, by their signatures alone. With ``asks`` only
    pairs of one that asks and, second, one that does not."""
    for inside in windows(size, percent):
        parts = [inside] if asks is None else [inside[asks[inside]], inside[~asks[inside]]]
        if min(map(len, parts)):
            flat = folded([maps[i] for part in parts for i in part])
            made = np.split(flat, [len(parts[0])])
            trees = [Tree(m, size[part], component[part], depth(max(map(len, parts)))) for m, part in zip(made, parts)]
            for a, b in candidates(trees[0], percent, *trees[1:]):
                i, j = parts[0][a], parts[-1][b]
                yield i[i != j], j[i != j]
