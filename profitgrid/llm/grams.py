"""Identifiers of all q-grams of many byte strings at once, and sample positions chosen by content."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 64, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    """0: powers of the base, 1: of its inverse; grown when a longer block comes."""
    if len(_powers[which]) < n:
        steps = np.full(max(n, 1 << 16), (BASE, INVERSE)[which], np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, best: np.ufunc, neutral: np.uint64) -> np.ndarray:
    """best of x[i : i + width] for each i where that lies inside x; three passes whatever the width."""
    n = len(x)
    padded = np.full(-(-n // width) * width, neutral, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    forward = best.accumulate(blocks, axis=1).ravel()
    backward = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(backward[: n - width + 1], forward[width - 1 : n])


@dataclass
class Block:
    """Byte strings laid end to end, with running sums from which any substring's identifier follows."""

    starts: np.ndarray
    ends: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, strings: list[bytes]) -> Block:
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        ends = np.cumsum(sizes)
        signs = np.frombuffer(b"".join(strings), np.uint8)
        sums = np.zeros(len(signs) + 1, np.uint64)
        np.cumsum(_VALUES[signs] * _power(1, len(signs)), out=sums[1:])
        return cls(ends - sizes, ends, sums)

    @property
    def size(self) -> int:
        return len(self.sums) - 1

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Identifiers of the substrings [start, end); equal strings have equal ones wherever they stand."""
        return mixed((self.sums[end] - self.sums[start]) * _power(0, self.size + 1)[start])

    def grams(self, q: int) -> np.ndarray:
        """Identifier of the q-gram at each position, those across string ends included."""
        if self.size < q:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[q:] - self.sums[:-q]) * _power(0, self.size + 1)[: self.size - q + 1])

    def lowest(self, q: int, length: int) -> np.ndarray:
        """For each start of ``length`` bytes the smallest identifier of their q-grams; 0 across string ends."""
        if self.size < length:
            return np.zeros(0, np.uint64)
        found = _sliding(self.grams(q), length - q + 1, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
        inside = np.zeros(self.size + 2, np.int32)
        long = self.ends - self.starts >= length
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, self.ends[long] - length + 1, -1)
        found[np.cumsum(inside)[: len(found)] == 0] = 0
        return found

    def samples(self, q: int, length: int) -> np.ndarray:
        """Positions of q-grams such that each string of ``length`` bytes inside one of the strings holds
        its own smallest one (ties included), chosen by nothing but those bytes."""
        lowest, ids = self.lowest(q, length), self.grams(q)
        if not len(lowest):
            return np.zeros(0, np.int64)
        around = np.zeros(len(ids) + length - q, np.uint64)
        around[length - q : length - q + len(lowest)] = lowest
        highest = _sliding(around, length - q + 1, np.maximum, np.uint64(0))
        return np.flatnonzero((highest == ids) & (highest > 0))
