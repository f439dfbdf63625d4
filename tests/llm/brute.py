"""Plain versions of the operators, one row or pair at a time."""

from __future__ import annotations

import hashlib
import re

import xxhash


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None, size: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [words[i : i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    """By id; compares each pair of distinct fingerprints."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind."""
    text = text or ""
    found = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def counts(kind: str, said: str) -> bool:
        digits = re.sub("[^0-9]", "", said)
        if kind == "ip":
            return all(int(p) <= 255 for p in said.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if counts(k, m.group())] for k, p in found.items()}


def said(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, own in spans.items() for a, b in own)


def secrets(text: str | None) -> list[tuple[int, str, int]]:
    """Base spans: start, kind, end."""
    found = {
        "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    order = list(found)
    spans = [(m.start(), order.index(k), k, m.end()) for k, (p, keep) in found.items() for m in re.finditer(p, text or "") if keep(m)]
    return [(s, k, e) for s, _, k, e in sorted(spans)]
