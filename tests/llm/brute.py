"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SECRETS = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile("[0-9a-f]+"), 0, 32),
}


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def contaminated(text: str | None, items: list) -> tuple[int, int, set]:
    words, hit, names = WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        w = WORD.findall(lower(item))
        for window in [w[s : s + 10] for s in range(max(1, len(w) - 9))] if w and item_id is not None else []:
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    names.add(item_id)
    return len(words), len(hit), names


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if w else 0


def groups(fingerprints: list[int], distance: int = 3) -> list[int]:
    """For each fingerprint the number of the first one that links reach."""
    root = list(range(len(fingerprints)))
    for _ in root:
        for i, a in enumerate(fingerprints):
            for j, b in enumerate(fingerprints):
                if (a ^ b).bit_count() <= distance:
                    root[i] = root[j] = min(root[i], root[j])
    return root


def without_repeats(texts: list[str | None], length: int = 200) -> list[tuple[int, int, int, str]]:
    raws = [(t or "").encode() for t in texts]
    starts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    result = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result.append((len(raw), sum(gone), spans, sha(kept)))
    return result
