"""A bidirectional FM-index over the delimited words of a vocabulary, and a search scheme for one error.

The text is all words between delimiters. One index reads patterns from left to right, the other from right
to left; an interval of suffix ranks stands for all places where what has been read so far occurs. The scheme
cuts a word into halves. One search reads the left half exactly and goes on across the right half with one
inserted, deleted or replaced letter, the other reads the right half exactly and goes on to the left. Each of
the two runs one way from its first letter to its last, so the two indexes need not follow each other. Steps
are taken for many words at once, in numpy.

A letter deleted from a run, or inserted beside an equal one, is placed at the end of the run. So every word
at distance one is found at one place, by one of the searches, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DELIMITER = "\n"
CHUNK = 8192


def _suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Start of each suffix, in order of the suffixes: the prefixes sorted so far double in length each round."""
    rank, n, length = text.astype(np.int64) + 1, len(text), 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - length)] = rank[length:]
        key = rank * (n + len(text) + 2) + later
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[1], 1 + np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n:
            return order
        length *= 2


class FmIndex:
    """Intervals of suffix ranks of ``text`` (codes from 0), extended by one letter in front."""

    def __init__(self, text: np.ndarray, letters: int) -> None:
        self.start = _suffix_ranks(text)
        before = text[self.start - 1]  # the last letter stands before the first
        blocks = len(text) // 64 + 1
        self.bits = np.zeros((blocks, letters), np.uint64)
        places = np.arange(len(text))
        np.bitwise_or.at(self.bits, (places >> 6, before), np.uint64(1) << (places & 63).astype(np.uint64))
        counts = np.bitwise_count(self.bits).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(counts.sum(0))[:-1]])
        self.below = first + np.cumsum(counts, axis=0) - counts

    def _mask(self, place: np.ndarray) -> np.ndarray:
        return (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)

    def by_letter(self, place: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """An end of each interval, after one letter each."""
        block = place >> 6
        return self.below[block, letter] + np.bitwise_count(self.bits[block, letter] & self._mask(place))

    def by_letters(self, place: np.ndarray) -> np.ndarray:
        """An end of each interval, after every letter (one column each)."""
        block = place >> 6
        return self.below[block] + np.bitwise_count(self.bits[block] & self._mask(place)[:, None])


class Vocabulary:
    """Words between delimiters, indexed in both directions."""

    def __init__(self, words: list[str]) -> None:
        text = np.frombuffer((DELIMITER + "".join(w + DELIMITER for w in words)).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        delimiters = np.flatnonzero(codes == 0)
        self.leftwards = FmIndex(codes, len(self.alphabet))
        self.rightwards = FmIndex(codes[::-1], len(self.alphabet))
        self.first = np.full(len(text), -1)
        self.first[delimiters[:-1]] = np.arange(len(words))
        self.last = np.full(len(text), -1)
        self.last[len(text) - 1 - delimiters[1:]] = np.arange(len(words))

    def near(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the asked word, number of the indexed word) for all pairs one error apart."""
        for part in (self.near_right, self.near_left):
            yield from part(words)

    def near_right(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs whose error lies behind the left half of the asked word."""
        for numbers, codes in self._asked(words):
            half = codes.shape[1] // 2
            who, rank = self._one_error(self.rightwards, codes, half, True)
            yield numbers[who], self.last[self.rightwards.start[rank]]

    def near_left(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs whose error lies before the right half of the asked word."""
        for numbers, codes in self._asked(words):
            half = codes.shape[1] // 2
            who, rank = self._one_error(self.leftwards, codes[:, ::-1], codes.shape[1] - half, False)
            yield numbers[who], self.first[self.leftwards.start[rank]]

    def _asked(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length as rows of codes; letters that no indexed word has are -1."""
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes).tolist():
            same = np.flatnonzero(sizes == size)
            for at in range(0, len(same), CHUNK):
                numbers = same[at : at + CHUNK]
                signs = np.frombuffer("".join([words[i] for i in numbers]).encode("utf-32-le"), np.uint32)
                codes = np.minimum(np.searchsorted(self.alphabet, signs), len(self.alphabet) - 1)
                codes[self.alphabet[codes] != signs] = -1
                yield numbers, codes.reshape(-1, size)

    def _one_error(self, index: FmIndex, word: np.ndarray, exact: int, forwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, suffix rank) of the indexed words that differ from a row of ``word`` by one error behind its
        first ``exact`` letters. Runs of equal letters end behind (``forwards``) or before the letter read."""
        rows, size = word.shape
        who = np.arange(rows)
        low, high = np.zeros(rows, np.int64), np.full(rows, index.below[0, 1] if len(self.alphabet) > 1 else 1)
        for i in range(exact):
            who, low, high = self._step(index, who, low, high, word[who, i])
        off = [np.zeros(0, np.int64)] * 3
        letters = np.arange(len(self.alphabet))
        for i in range(exact, size + 1):
            lows, highs = index.by_letters(low), index.by_letters(high)
            there = (lows < highs) & (letters > 0)
            here = word[who, i] if i < size else np.full(len(who), -1)
            parts = [off]
            if forwards or i > exact:
                beside = here if forwards else word[who, i - 1]
                a, c = np.nonzero(there & (letters != beside[:, None]))
                parts.append([who[a], lows[a, c], highs[a, c]])
            off = [np.concatenate(x) for x in zip(*parts, strict=True)]
            if i == size:
                break
            following = word[who, i + 1] if i + 1 < size else np.full(len(who), -2)
            gone = here != (following if forwards else word[who, i - 1])
            a, c = np.nonzero(there & (letters != here[:, None]))
            parts = [self._step(index, *off, word[off[0], i]), [who[a], lows[a, c], highs[a, c]], [who[gone], low[gone], high[gone]]]
            off = [np.concatenate(x) for x in zip(*parts, strict=True)]
            known = np.flatnonzero(here >= 0)
            known = known[there[known, here[known]]]
            who, low, high = who[known], lows[known, here[known]], highs[known, here[known]]
        found, low, high = self._step(index, *off, np.zeros(len(off[0]), np.int64))
        return found, low

    def _step(self, index: FmIndex, who: np.ndarray, low: np.ndarray, high: np.ndarray, letter: np.ndarray) -> list[np.ndarray]:
        known = letter >= 0
        who, low, high, letter = who[known], low[known], high[known], letter[known]
        low, high = index.by_letter(low, letter), index.by_letter(high, letter)
        left = low < high
        return [who[left], low[left], high[left]]
