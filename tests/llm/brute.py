"""Plain one-text-at-a-time versions of what the operators compute."""

import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_data(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def classes(texts, threshold=0.8):
    """Least id of each document's class by comparing all pairs; links between different texts."""
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = set()
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
                if texts[a] != texts[b]:
                    linked |= {a, b}
    return {d: find(d) for d in sets}, linked


def rule_counts(text):
    w = words(text)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    number = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if number[r] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def crc(text):
    return zlib.crc32(str(text).encode())
