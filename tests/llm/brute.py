"""Plain Python versions of what the operators compute, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _spans(kind, pattern, text, holds=lambda m: True):
    return [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if holds(m)]


def _plain(value: str) -> str:
    return re.sub("[^0-9]", "", value)


def _near(text: str, start: int, pattern: str) -> bool:
    return re.search(pattern, text[max(0, start - 48) : start].lower()) is not None


def _mod97(m) -> bool:
    value = m[0].replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def pii(text: str | None) -> list[tuple]:
    text = text or ""
    return [
        *_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
        *_spans(
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            text,
            lambda m: all(int(p) <= 255 for p in m[0].split(".")),
        ),
        *_spans(
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            text,
            lambda m: 16 <= len(_plain(m[0])) <= 19 and luhn(_plain(m[0])),
        ),
        *_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 8 <= len(_plain(m[0])) <= 15),
        *_spans(
            "iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])", text, _mod97
        ),
        *_spans(
            "ssn",
            r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
            text,
            lambda m: _near(text, m.start(), "ssn|social|security|sozial|seguridad"),
        ),
    ]


def entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _random(m) -> bool:
    value = m[0]
    allowed = (
        r"[^0-9]*\Z",
        r"[^A-Za-z]*\Z",
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z",
        r"(?i)(sha(1|256|384|512)|md5)[-_=]",
    )
    if any(re.match(p, value) for p in allowed):
        return False
    if re.search(r"(?i)example|placeholder|changeme|x{6}|0123456789|abcdefgh", value):
        return False
    windows = [value[i : i + 20] for i in range(len(value) - 19)]
    part = "(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
    account = re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value) and _mod97(m)
    known = account or re.fullmatch(f"{part}(?:[+/_=-]+{part})+", value)
    limits = (
        ("[0-9a-fA-F]+", 3.05),
        ("[A-Z2-7]+|[a-z2-7]+", 3.95 if known else 3.34),
        ("[A-Z0-9]+|[a-z0-9]+", 3.95 if known else 3.40),
        ("[A-Za-z0-9+/_=-]+", 3.95 if known else 3.64),
    )
    return any(re.fullmatch(p, w) and entropy(w) >= least - 1e-9 for w in set(windows) for p, least in limits)


def secrets(text: str | None) -> list[tuple]:
    text = text or ""
    assign = (
        r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    found = [
        *_spans("assign", assign, text, lambda m: len(m[2]) >= 6),
        *_spans("access", r"AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 20),
        *_spans("hex", r"[0-9a-f]+", text, lambda m: len(m[0]) >= 24),
        *_spans("entropy", r"[A-Za-z0-9+/_=-]{20,}", text, _random),
    ]
    rank = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}
    return sorted(found, key=lambda s: (s[1], rank[s[0]]))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shingles(text: str | None) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def classes(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, int]:
    """Id to the least id of its component, from all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_size = sorted(sets, key=lambda s: s[1].total())
    for n, (i, a) in enumerate(by_size):
        for j, b in by_size[n + 1 :]:
            if not a or a.total() < threshold * b.total():
                continue
            if (a & b).total() >= threshold * (a | b).total() - 1e-9:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in rows}


def pieces(key: int, ids: list[int], capacity: int = 4096) -> list[tuple]:
    ids = [*ids, 1]
    out = []
    for n, lo in enumerate(range(0, len(ids), capacity)):
        part = ids[lo : lo + capacity]
        data = b"".join(x.to_bytes(4, "little") for x in part)
        out.append((key, n, lo, len(part), zlib.crc32(data)))
    return out


def contamination(text: str | None, items: list[tuple], window: int = 10) -> tuple[int, int, list[str]]:
    """Words, words hit, items found."""
    w = words(text)
    hit, found = set(), set()
    for item_id, item_text in items:
        x = words(item_text)
        size = min(window, len(x))
        windows = {tuple(x[i : i + size]) for i in range(len(x) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("null" if item_id is None else str(item_id))
    return len(w), len(hit), sorted(found)


def lm_scores(rows: list[tuple], alpha: float = 0.4, min_count: int = 2) -> list[tuple]:
    """Id, words, words that backed off, bigram score."""
    docs = [(i, words(t)) for i, t in rows]
    one = Counter(w for _, d in docs for w in d)
    two = Counter(p for _, d in docs for p in zip(d, d[1:], strict=False))
    total = max(1, one.total())
    out = []
    for i, d in docs:
        score, backed = 0.0, 0
        for n, w in enumerate(d):
            pair = (d[n - 1], w) if n else None
            if pair and two[pair] >= min_count:
                score += math.log(two[pair] / one[pair[0]])
            else:
                score += math.log(one[w] / total) + (math.log(alpha) if pair else 0)
                backed += pair is not None
        out.append((i, len(d), backed, score))
    return out
