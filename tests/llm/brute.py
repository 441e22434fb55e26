"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def repeated_windows(sequences, width):
    seen = defaultdict(list)
    for d, s in enumerate(sequences):
        for i in range(len(s) - width + 1):
            seen[tuple(s[i : i + width]) if isinstance(s, list) else s[i : i + width]].append((d, i))
    gone = [set() for _ in sequences]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + width))
    return gone


def long_matches(pairs, length):
    bodies = [(t or "").encode() for _, t in pairs]
    out = []
    for (i, _), body, gone in zip(pairs, bodies, repeated_windows(bodies, length)):
        spans = sum(p - 1 not in gone for p in gone)
        out.append((i, len(body), len(gone), spans, sha(bytes(b for p, b in enumerate(body) if p not in gone))))
    return out


def word_repeats(pairs, window):
    lists = [words(t) for _, t in pairs]
    return [
        (i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone).encode()))
        for (i, _), w, gone in zip(pairs, lists, repeated_windows(lists, window))
    ]


def shingles(text, size=5):
    w = words(lower(text))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_duplicates(pairs, percent=75):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            same = pairs[a][0] is not None and pairs[a][0] == pairs[b][0] and sets[a] and sets[b]
            if same or (sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(pairs)):
        groups[find(k)].append(pairs[k][0])
    out = []
    for k, (i, _) in enumerate(pairs):
        ids = [x for x in groups[find(k)] if x is not None]
        component = min(ids) if ids else None
        out.append((i, len(sets[k]), component, i == component))
    return out


def quality(pairs, window=8):
    out = []
    for i, text in pairs:
        w, body = words(text), text or ""
        lines = [x for x in body.split("\n") if words(x)]
        spots = defaultdict(list)
        for p in range(len(w) - window + 1):
            spots[tuple(w[p : p + window])].append(p)
        covered = {q for places in spots.values() if len(places) > 1 for p in places for q in range(p, p + window)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in body), len(lines) - len(set(lines)), len(covered), failed))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def personal(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(found)


def counted(rows):
    return Counter(map(tuple, rows))
