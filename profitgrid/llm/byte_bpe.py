"""A byte-level BPE vocabulary read from a tokenizer file: words of a text, merges of a word, bytes of a token."""

from __future__ import annotations

import functools
import heapq
import json

import regex

# The word pattern of byte-level BPE, with contractions, letters, digits, other signs, white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and digits younger than the Unicode tables of the tokenizers library, where they are other signs.
LATER_LETTERS = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3"
    "\U00016ff2-\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    "\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# Bytes that stand for themselves in the vocabulary's printable alphabet.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

CACHED_WORDS = 400_000
CACHED_LENGTH = 100


def byte_of_sign() -> dict[str, int]:
    """Sign of the printable alphabet -> byte; bytes that are not printable follow from 256 on."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """Vocabulary and merge ranks; encodes one word with a priority queue over a linked list of symbols."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = byte_of_sign()
        size = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token_bytes = [b""] * size
        self.id_of: dict[bytes, int] = {}
        for sign, i in spec["model"]["vocab"].items():
            if all(c in byte for c in sign):
                self.token_bytes[i] = bytes(byte[c] for c in sign)
                self.id_of[self.token_bytes[i]] = i
        vocab = spec["model"]["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.token_bytes))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.token_bytes[i] = content.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self._findall = regex.compile(WORD_PATTERN).findall
        self._later = regex.compile(f"[{LATER_LETTERS}]")

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not self._later.search(text):
            return self._findall(text)
        words, end = [], 0
        for seen in self._findall(self._later.sub("\ue000", text)):  # a sign that is neither letter nor digit
            words.append(text[end : end + len(seen)])
            end += len(seen)
        return words

    def words(self, text: str) -> list[str]:
        """The text cut into words; the string of a special token is a word of its own."""
        if self._special is None or not any(s in text for s in self.special):
            return self._words(text)
        return [w for part in self._special.split(text) for w in ([part] if part in self.special else self._words(part))]

    def merged(self, word: bytes) -> list[int]:
        """Token ids of one word: the pair of lowest rank merges first, the leftmost among equals.

        Symbols form a doubly linked list. The queue may hold pairs that a neighbouring merge has
        changed meanwhile; such stale entries are skipped when they come up.
        """
        ids = [self.byte_id[b] for b in word]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.merges.get
        queue = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := ranks((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, new, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := ranks((new, ids[k])):
                    heapq.heappush(queue, (*found, i, new, ids[k]))
            if (h := before[i]) >= 0 and (found := ranks((ids[h], new))):
                heapq.heappush(queue, (*found, h, ids[h], new))
        return [i for i in ids if i >= 0]


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One vocabulary per Python worker and file."""
    return ByteBpe(path)


class WordCache(dict):
    """Word -> what ``compute`` makes of it. Long words are not kept.

    A full cache becomes the old generation and a new one begins; words that come up again move over, so
    frequent words stay and memory is bounded by two generations.
    """

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute = compute
        self.old: dict = {}

    def __missing__(self, word: str):
        made = self.old.get(word)
        if made is None:
            made = self.compute(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = made
        return made
