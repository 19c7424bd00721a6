"""The numeric core of the language model: bit predictors over a sorted page of words, mixed by gated weights.

A word is spelled as a byte for the state it is met in, its UTF-8 bytes and a blank; the end of a text has no bytes of its
own. The state is known, all other bits are predicted, most significant first. Contexts of a bit, next to the bits of its byte so far, are everything spelled so far (whose counts
are exact: in sorted words a prefix is a range) and the last two to four bytes (hashed tables of counts). Every
predictor gives a log odds; weights, chosen by the bit's number and by how often the prefix was seen, mix them; a table
indexed by the same choice and by the mixed odds refines the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BYTES = (2, 3, 4)  # the last bytes that are contexts
TABLE_BITS = (18, 19, 19)  # slots of their tables
STARTS = np.cumsum([0, *(1 << b for b in TABLE_BITS)])
SLOTS = int(STARTS[-1])
SEEN = np.array([1, 2, 4, 16, 256])  # borders between the classes of prefix counts
CLASSES = len(SEEN) + 1
GATES, INPUTS, LEVELS = 8 * CLASSES, len(TABLE_BITS) + 2, 33
START_WEIGHTS = np.array([0.5, 0.1, 0.2, 0.25, 0.0])
ALPHA, RATE, CHUNK, LEAST = np.float32(0.4), 0.005, 1 << 15, 1e-7


def common_bits(a: bytes, b: bytes) -> int:
    """Of two different spelled words the number of leading bits that agree."""
    j = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
    return 8 * j + 8 - (a[j] ^ b[j]).bit_length()


def node_key(word: bytes, depth: int) -> tuple[int, bytes]:
    """The first ``depth`` bits of a spelled word."""
    whole, rest = divmod(depth, 8)
    return depth, word[:whole] + (bytes([word[whole] >> 8 - rest]) if rest else b"")


class Page:
    """Distinct words in the order of their spelling, with how often each occurs in training."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        flat = b" ".join(words) + b" "
        self.flat = np.frombuffer(flat, np.uint8)
        self.ends = np.flatnonzero(self.flat == 32) + 1
        self.starts = np.r_[0, self.ends[:-1]]
        self.counts = np.asarray(counts, np.float64)
        self.first, self.last = words[0] + b" ", words[-1] + b" "
        same = np.arange(len(words) - 1)
        self.shared = np.zeros(len(words) - 1, np.int64)  # leading bytes that neighbours have in common
        j = 0
        while len(same):
            same = same[self.flat[self.starts[same] + j] == self.flat[self.starts[same + 1] + j]]
            j += 1
            self.shared[same] = j

    def levels(self, before: int, after: int) -> Iterator[tuple]:
        """Words and a position in each that share what is before it with a neighbour, in order; then all other words
        and positions, in chunks. ``before`` and ``after`` are the bits that the pages beside this one share with it."""
        most = np.maximum(np.r_[before // 8 if before >= 0 else -1, self.shared],
                          np.r_[self.shared, after // 8 if after >= 0 else -1])
        words, j = np.flatnonzero(most >= 0), 0
        while len(words):
            yield words, j, True
            j += 1
            words = words[most[words] >= j]
        rest = self.ends - self.starts - (most + 1)
        at = np.flatnonzero(rest > 0)
        while len(at):  # whole words up to a chunk; one longer than that alone
            take = max(1, int(np.searchsorted(np.cumsum(rest[at]), CHUNK, "right")))
            words, at = np.repeat(at[:take], rest[at[:take]]), at[take:]
            first = np.r_[True, words[1:] != words[:-1]]
            order = np.arange(len(words))
            yield words, order - np.maximum.accumulate(np.where(first, order, 0)) + most[words] + 1, False

    def nodes(self, outside: dict | None, before: int, after: int) -> Iterator[tuple]:
        """For every bit of every word: words, positions, byte values, the bit's number, its value, and in training how
        often its prefix occurs and is followed by a one. ``outside`` has the totals of nodes shared with other pages."""
        for words, j, together in self.levels(before, after):
            value = self.flat[self.starts[words] + j].astype(np.int64)
            count = self.counts[words]
            if together:
                edge = np.r_[True, (words[1:] != words[:-1] + 1) | (self.shared[words[1:] - 1] < j)]
            for b in range(8):
                bit = (value >> 7 - b) & 1
                if not together:
                    yield words, j, value, b, bit, count, count * bit
                    continue
                if b:
                    head = value >> 8 - b
                    edge = edge | np.r_[True, head[1:] != head[:-1]]
                at = np.flatnonzero(edge)
                sizes = np.diff(np.r_[at, len(words)])
                total, ones = np.add.reduceat(count, at), np.add.reduceat(count * bit, at)
                if outside is not None:
                    depth = 8 * j + b
                    if depth <= before and words[0] == 0:
                        total[0], ones[0] = outside[node_key(self.first, depth)]
                    if depth <= after and words[-1] == len(self.counts) - 1:
                        total[-1], ones[-1] = outside[node_key(self.last, depth)]
                yield words, j, value, b, bit, np.repeat(total, sizes), np.repeat(ones, sizes)

    def edge_nodes(self, before: int, after: int) -> dict[tuple[int, bytes], tuple[float, float]]:
        """This page's share of the nodes that it has in common with other pages."""
        found = {}
        for words, j, _, b, _, total, ones in self.nodes(None, before, after):
            if np.ndim(j):
                break
            if 8 * j + b <= before and words[0] == 0:
                found[node_key(self.first, 8 * j + b)] = (total[0], ones[0])
            if 8 * j + b <= after and words[-1] == len(self.counts) - 1:
                found[node_key(self.last, 8 * j + b)] = (total[-1], ones[-1])
        return found

    def contexts(self, words: np.ndarray, j) -> list[np.ndarray]:
        """Hashes of the last bytes before a position; before a word's start there are zeros."""
        at, out, known = self.starts[words] + j, [], np.zeros(len(words), np.uint64)
        j = np.broadcast_to(j, len(words))
        for k in range(1, max(BYTES) + 1):
            byte = np.where(j >= k, self.flat[np.maximum(at - k, 0)], 0).astype(np.uint64)
            known = known * np.uint64(256) + byte
            if k in BYTES:
                out.append(known * np.uint64(0x9E3779B97F4A7C15))
        return out


def slots(context: np.ndarray, k: int, node: np.ndarray) -> np.ndarray:
    """Table slots of contexts with the bits of the byte so far (``node`` has a leading one)."""
    mixed = (context ^ (node.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(64 - TABLE_BITS[k])).astype(np.int64) + STARTS[k]


def table_counts(page: Page, tables: np.ndarray) -> None:
    """Add a page's bits to the tables, the counts of zeros and, ``SLOTS`` further on, those of ones."""
    for words, j, _ in page.levels(-1, -1):
        known = (page.counts[words] > 0) & (np.asarray(j) > 0)  # position 0 is the state
        words, j = words[known], (j[known] if np.ndim(j) else j)
        if not len(words):
            continue
        value, count = page.flat[page.starts[words] + j].astype(np.int64), page.counts[words]
        context = page.contexts(words, j)
        for b in range(8):
            bit, node = (value >> 7 - b) & 1, (value >> 8 - b) | (1 << b)
            for k, c in enumerate(context):
                np.add.at(tables, slots(c, k, node) + SLOTS * bit, count)


def _class(seen: np.ndarray) -> np.ndarray:
    """The number of borders in ``SEEN`` up to each count; a few comparisons are quicker than a search."""
    found = np.zeros(len(seen), np.uint8)
    for border in SEEN:
        found += seen >= border
    return found.astype(np.int64)


def odds(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    return np.log((ones.astype(np.float32) + ALPHA) / (zeros.astype(np.float32) + ALPHA))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Learner:
    """Weights on their way and their mean so far, with the sums for the last refinement."""

    zeros: np.ndarray
    ones: np.ndarray
    weights: np.ndarray
    squares: np.ndarray
    mass: np.ndarray
    weighed: np.ndarray
    seen: np.ndarray
    hits: np.ndarray

    @classmethod
    def start(cls, zeros: np.ndarray, ones: np.ndarray) -> "Learner":
        return cls(zeros, ones, np.tile(START_WEIGHTS, (GATES, 1)), np.full((GATES, INPUTS), 1e-3), np.zeros(GATES),
                   np.zeros((GATES, INPUTS)), np.zeros(GATES * LEVELS), np.zeros(GATES * LEVELS))

    def learn(self, page: Page, outside: dict, before: int, after: int) -> None:
        """One online pass. A bit is predicted from all other tokens: its own is taken out of every count."""
        context, last = None, None
        for words, j, value, b, bit, total, ones in page.nodes(outside, before, after):
            if b == 0:
                last = (page.counts[words] > 0) & (np.asarray(j) > 0)
                context = page.contexts(words[last], j[last] if np.ndim(j) else j)
            words, value, bit, total, ones = (a[last] for a in (words, value, bit, total, ones))
            if not len(words):
                continue
            weight, node = page.counts[words], (value >> 8 - b) | (1 << b)
            inputs = [odds(ones - bit, total - ones - (1 - bit))]
            one = bit.astype(np.float32)
            zero = 1 - one
            for k, c in enumerate(context):
                at = slots(c, k, node)
                inputs.append(odds(np.maximum(self.ones.take(at) - one, 0), np.maximum(self.zeros.take(at) - zero, 0)))
            gate = b * CLASSES + _class(total - 1)
            weights = np.ascontiguousarray(self.weights.T, np.float32)
            z = weights[INPUTS - 1].take(gate)
            for i, x in enumerate(inputs):
                z += x * weights[i].take(gate)
            p = _sigmoid(z)
            bucket = gate * LEVELS + _level(z)
            self.seen += np.bincount(bucket, weight, GATES * LEVELS)
            self.hits += np.bincount(bucket, weight * bit, GATES * LEVELS)
            mass = np.bincount(gate, weight, GATES)
            error = weight * (bit - p)
            slope = np.stack([np.bincount(gate, x, GATES) for x in [*(error * x for x in inputs), error]], axis=1)
            self.squares += slope ** 2
            self.weights += RATE * slope / np.sqrt(self.squares)
            self.mass += mass
            self.weighed += self.weights * mass[:, None]


def _level(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(z * 2), -(LEVELS // 2), LEVELS // 2).astype(np.int64) + LEVELS // 2


@dataclass
class Model:
    """What scoring needs: log odds of the tables, mixing weights and the refinement."""

    table: np.ndarray
    weights: np.ndarray
    refine: np.ndarray

    @classmethod
    def finish(cls, zeros: np.ndarray, ones: np.ndarray, weights: np.ndarray, seen: np.ndarray, hits: np.ndarray) -> "Model":
        middle = _sigmoid((np.arange(LEVELS) - LEVELS // 2) / 2)
        refine = (hits.reshape(GATES, LEVELS) + 20 * middle) / (seen.reshape(GATES, LEVELS) + 20)
        return cls(odds(ones, zeros).astype(np.float32), weights, refine.ravel())

    def log10(self, page: Page, outside: dict, before: int, after: int) -> np.ndarray:
        """The log10 probability of every word of a page."""
        score, context, weights = np.zeros(len(page.counts)), None, np.ascontiguousarray(self.weights.T, np.float32)
        byte = None  # the probability of the byte's bits so far; that of eight is far from too small for a number
        for words, j, value, b, bit, total, ones in page.nodes(outside, before, after):
            if not np.any(j):
                continue  # the state
            if b == 0:
                context = page.contexts(words, j)
            node = (value >> 8 - b) | (1 << b)
            gate = b * CLASSES + _class(total)
            z = odds(ones, total - ones) * weights[0].take(gate) + weights[INPUTS - 1].take(gate)
            for k, c in enumerate(context):
                z += self.table.take(slots(c, k, node)) * weights[k + 1].take(gate)
            p = (_sigmoid(z) + self.refine[gate * LEVELS + _level(z)]) / 2
            p = np.clip(p.astype(np.float64), LEAST, 1 - LEAST)
            p = np.where(j > 0, np.where(bit == 1, p, 1 - p), 1.0)
            byte = p if b == 0 else byte * p
            if b < 7:
                continue
            if np.ndim(j):
                score += np.bincount(words, np.log10(byte), len(score))
            else:
                score[words] += np.log10(byte)
        return score
