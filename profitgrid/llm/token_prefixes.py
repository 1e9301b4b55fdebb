"""Operator 7: token counts by prefix dynamic programming.

For every prefix of a word the last token of its encoding is stored: token t may end prefix i if the
prefix without t ends in a token s such that s and t stay apart when both are encoded together. There is
exactly one such t, and the count is that of the shorter prefix plus one. An automaton of all tokens lists
those that end at each byte, so only they are tried. Whether two tokens stay apart follows from their merges,
undone from the last to the first: nothing is encoded. Words are independent, so the count at every prefix
of a text is the sum of the words before it plus the count inside the word that it cuts. Truncation and
budget questions are then look-ups.

Two cuts change how a text splits into words and are put right: a prefix that ends in a run of white space
keeps the run together, and a cut contraction ("'r" of "'re") is two words. A cut special token counts as
ordinary bytes of one word; all other counts equal those of the library for the prefix as a text.

Defined cases: NULL and empty texts have no bytes and no tokens; repeated rows give repeated results; NULL
doc_ids are kept; other columns are not looked at; long words cost (length x tokens that end at a byte).
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Callable

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from profitgrid.llm import byte_bpe
from profitgrid.llm.bpe_codec import vocabulary
from profitgrid.llm.common import per_row, table

LIMIT = 1024
SPACE = regex.compile(r"\s+")
CONTRACTIONS = ("'re", "'ve", "'ll")  # a shorter one cannot be cut inside


class Pairs:
    """Whether two tokens, each the encoding of its own bytes, stay apart when they stand side by side.

    Encoding merges the pair of lowest rank first, the leftmost among equals, and a merge always has a higher
    rank than those that made its parts (else ``ordered`` is false and pairs are encoded instead). So the two
    signs that meet at the border are known at every moment of the encoding: undoing the later of the two
    tokens' last merges gives those before it. The tokens do not stay apart if at some moment the two signs
    have a merge of their own that comes before the next merge that takes one of them away.
    """

    def __init__(self, bpe: byte_bpe.ByteBpe) -> None:
        self.bpe = bpe
        self.parts: list[tuple[int, int, int]] = [(-1, -1, -1)] * len(bpe.token_bytes)  # rank, left, right
        made: dict[int, int] = {}
        self.ordered = True
        for (left, right), (rank, new) in bpe.merges.items():
            made[new] = made.get(new, 0) + 1
            self.parts[new] = (rank, left, right)
        for rank, left, right in self.parts:
            if rank >= 0 and rank <= max(self.parts[left][0], self.parts[right][0]):
                self.ordered = False
        self.ordered &= all(n == 1 for n in made.values())

    def apart(self, left: int, right: int) -> bool:
        if not self.ordered:
            strings = self.bpe.token_bytes
            return self.bpe.merged(strings[left] + strings[right]) == [left, right]
        merges, parts = self.bpe.merges, self.parts
        limit, tie = 1 << 60, False
        while True:
            found = merges.get((left, right))
            if found and (found[0] < limit or tie and found[0] == limit):
                return False
            of_left, of_right = parts[left], parts[right]
            if of_left[0] > of_right[0]:
                limit, tie, left = of_left[0], False, of_left[2]
            elif of_right[0] >= 0:  # of equal merges the left one comes first, so the right one is undone first
                limit, tie, right = of_right[0], True, of_right[1]
            else:
                return True


class PrefixCounter:
    """Counts at every prefix of words and texts for one vocabulary."""

    def __init__(self, path: str) -> None:
        self.bpe = byte_bpe.load(path)
        self.pairs = Pairs(self.bpe)
        self.words = byte_bpe.WordCache(self._word)
        self._apart: dict[int, bool] = {}
        self._automaton = ahocorasick.Automaton()
        for string, token in self.bpe.id_of.items():
            whole = self.bpe.merged(string) == [token]
            if whole:  # no other token can be part of an encoding
                self._automaton.add_word(string.decode("latin-1"), (len(string), token))
        self._automaton.make_automaton()

    def of_word(self, word: bytes) -> list[int]:
        """Number of tokens of word[:1], word[:2], ... word."""
        last, counts = [0] * (len(word) + 1), [0] * (len(word) + 1)
        known = self._apart
        for end, (size, token) in self._automaton.iter(word.decode("latin-1")):
            end += 1
            if counts[end]:
                continue
            start = end - size
            if start:
                pair = last[start] << 32 | token
                apart = known.get(pair)
                if apart is None:
                    if len(known) >= byte_bpe.CACHED_WORDS:
                        known.clear()
                    apart = known[pair] = self.pairs.apart(last[start], token)
                if not apart:
                    continue
            last[end], counts[end] = token, counts[start] + 1
        return counts[1:]

    def _word(self, word: str) -> tuple[int, int, bytes, bool]:
        """Bytes, tokens, counts at the prefixes as int32, and whether it is white space only."""
        raw = word.encode()
        if word in self.bpe.special:
            counts = self.of_word(raw[:-1]) + [1]
        else:
            counts = self.of_word(raw)
            if word in CONTRACTIONS:
                counts[1] = 2
        blank = not word[-1].isalnum() and SPACE.fullmatch(word) is not None
        return len(raw), counts[-1], array("i", counts).tobytes(), blank

    def total(self, text: str) -> int:
        """Token count of a whole text."""
        return sum([found[1] for found in map(self.words.__getitem__, self.bpe.words(text))])

    def total_and_fitting(self, text: str, raw: bytes, limit: int) -> tuple[int, int]:
        """Token count of a whole text, and the bytes of its longest prefix with at most ``limit`` tokens.

        Behind the first word that begins after more than ``limit`` tokens no prefix fits, nor, since a run of
        white space may be cut in two, behind the word after it; so only the prefixes before are compared.
        """
        words = self.bpe.words(text)
        totals = [found[1] for found in map(self.words.__getitem__, words)]
        total = sum(totals)
        if total <= limit:
            return total, len(raw)
        before, near = 0, 0
        while before <= limit:
            before += totals[near]
            near += 1
        counts = self._of_words(words[: near + 2])
        return total, longest_fitting(counts, raw[: len(counts)], limit)

    def of_text(self, text: str) -> np.ndarray:
        """Token count at every byte prefix: element i is that of the first i + 1 bytes."""
        return self._of_words(self.bpe.words(text))

    def _of_words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int32)
        sizes, totals, inside, spaces = zip(*map(self.words.__getitem__, words), strict=True)
        sizes, totals = np.array(sizes), np.array(totals, np.int32)
        ends, base = np.cumsum(sizes), np.cumsum(totals, dtype=np.int32) - totals
        counts = np.frombuffer(b"".join(inside), np.int32) + np.repeat(base, sizes)
        for k in np.flatnonzero(spaces[:-1]):
            if SPACE.match(words[k + 1]):  # the run's last sign went to the next word
                run = words[k] + words[k + 1][0]
                counts[ends[k] + len(words[k + 1][0].encode()) - 1] = base[k] + self.words[run][1]
        return counts


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def longest_fitting(counts: np.ndarray, raw: bytes, limit: int) -> int:
    """Bytes of the longest prefix, cut between signs, that has at most ``limit`` tokens."""
    if not len(counts) or counts[-1] <= limit:
        return len(counts)
    starts = (np.frombuffer(raw, np.uint8)[1:] & 0xC0) != 0x80  # byte i + 1 starts a sign, so prefix i + 1 is whole
    fitting = np.flatnonzero(starts & (counts[:-1] <= limit))
    return int(fitting[-1]) + 1 if len(fitting) else 0


def prefix_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns but the text, and ``counts``: int32 little-endian, the count at every byte prefix."""

    def make() -> Callable[[str], tuple]:
        return lambda value: (counter(path).of_text(value).astype("<i4").tobytes(),)

    return per_row(docs, text, "counts binary", make)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """Bytes, tokens, whether there are more than ``limit``, and the longest prefix that fits into it."""

    def make() -> Callable[[str], tuple]:
        def row(value: str) -> tuple:
            raw = value.encode()
            total, fitting = counter(path).total_and_fitting(value, raw, limit)
            return len(raw), total, total > limit, fitting

        return row

    return per_row(docs, text, "n_bytes bigint, n_tokens bigint, over_limit boolean, fitting_bytes bigint", make)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary())
