"""Personal data found by rules and by a semi-Markov conditional random field.

Rules find emails, addresses, card and phone numbers; their spans stay as they are. The model
adds spans that the rules leave out: other spellings of these kinds, and secrets. It scores
whole candidate spans of up to ``LONGEST`` tokens by features of the span as a whole (how many
digits, checksum, parts, what stands before it) and a dynamic program over a region chooses
boundaries and kinds jointly; a span that overlaps one of the rules is dropped.

Training is on the driver and bounded: at most ``REGIONS`` regions of at most ``REGION_TOKENS``
tokens, those with the least hashes over all documents, labelled by the rules and by key
patterns, plus rewritten copies of them in which a known span is spelled another way (emails
also without digits, secrets in letters), and as many regions that have only a word as their signal.

The model looks at text near a signal: a digit of any script, ``@`` in either width, ``=``, ``:``,
the words ``at`` and ``dot`` in any case and brackets, a key word such as ``password``, three
number words in a row, or sixteen letters in a row. These begin all that training labels, its
other spellings, and all features but those of a word's letters and shape; text without a
signal has nothing else to be told by, and is not scored. Signals are found for whole batches
of texts at once, by tables over bytes and hashes of letter runs.

Positions are code points, ends exclusive. Defined results: null or empty texts have no span;
repeated rows and rows with a null id are searched one by one; an empty table gives an empty
one and trains no model. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm import textbatch as tb
from tiermill.session import freeze

KINDS = ("email", "ip", "card", "phone", "secret")
#: Bounds of the training set and of an entity.
REGIONS, REGION_TOKENS, LONGEST = 400, 48, 7
ROUNDS, RATE, DECAY = 5, 0.3, 1e-3
#: Sums of weights that a task keeps at hand.
SUMS = 1 << 16

# What the rules match.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\s=\"'(),;:<>\[\]{}]+|[=\"'(),;:<>\[\]{}]")
_TAIL = re.compile(r"[.!?]+$")
_SECRET = re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?<=[=:])\s*\"?[0-9a-f]{16,}\b")
_KEYWORDS = (
    "password", "passwd", "passphrase", "passcode", "pass", "pwd", "pin", "token", "secret", "key", "apikey", "api_key", "credential", "credentials",
)
_NUMBERS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_AT, _DOT = re.compile(r"@|＠|[\[( ]at[\]) ]", re.I), re.compile(r"\.|[\[( ]dot[\]) ]", re.I)
REACH = 3
#: What the rules and the key patterns can begin with.
_STRONG = re.compile(r"[0-9@=]|\b[dD][oO][tT]\b")
_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isdigit())
_OTHER_DIGIT = re.compile(f"[{_OTHER_DIGITS}]")
_MARK = np.zeros(256, bool)
_MARK[list(b"0123456789@=:")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: So many letters in a row may be a key.
LETTERS = 16


_SIGNAL_WORDS = frozenset(w.encode() for w in ("at", "dot", *_KEYWORDS) if "_" not in w)
_NUMBER_WORDS = frozenset(w.encode() for w in _NUMBERS)
#: By the first two letters and the length: whether a run of letters can be one of these words.
_OPENING = np.zeros((26, 26, LETTERS), bool)
for _w in _SIGNAL_WORDS | _NUMBER_WORDS:
    _OPENING[_w[0] - 97, _w[1] - 97, len(_w)] = True

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The part before @ is all of its run, so it is taken backwards from each @: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """A run of dotted numbers gives one match for each four parts."""
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, at = run.group().split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of what the rules find, by start and kind."""
    if not _ANY.search(text):
        return []
    found = [(a, 0, z) for a, z in _emails(text)] if "@" in text else []
    found += [(a, 1, z) for a, z in _addresses(text)] if "." in text else []
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Words and single marks; closing dots are tokens of their own."""
    found = []
    for m in _TOKEN.finditer(text, start, end):
        tail = _TAIL.search(m.group())
        cut = m.start() + tail.start() if tail else m.end()
        if cut > m.start():
            found.append((m.start(), cut))
        if tail:
            found.append((cut, m.end()))
    return found


def _signals(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which of the words hold a signal."""
    hot = _MARK[data]
    hot[2:] |= (data[2:] == 0xA0) & (data[1:-1] == 0xBC) & (data[:-2] == 0xEF)  # the wide at sign
    letter = _LETTER[data]
    opens, shuts = letter.copy(), letter.copy()
    opens[1:] &= ~letter[:-1]
    shuts[:-1] &= ~letter[1:]
    opens[start], shuts[end - 1] = letter[start], letter[end - 1]  # a run ends with its text
    first = np.flatnonzero(opens)
    size = np.flatnonzero(shuts) + 1 - first
    hot[first[size >= LETTERS]] = True
    number = np.zeros(len(data) + 1, bool)
    ok = (size > 1) & (size < LETTERS)
    first, size = first[ok], size[ok]
    lower = tb.LOWER[data]
    near = np.flatnonzero(_OPENING[lower[first] - 97, lower[first + 1] - 97, size])
    body = lower.tobytes()
    for at, n in zip(first[near].tolist(), size[near].tolist()):
        word = body[at : at + n]
        if word in _SIGNAL_WORDS:
            hot[at] = True
        elif word in _NUMBER_WORDS:
            number[at] = True
    seen = np.append(0, np.cumsum(hot))
    found = seen[end] > seen[start]
    seen = np.append(0, np.cumsum(number))
    number = seen[end] > seen[start]
    row = np.flatnonzero(number[:-2] & number[1:-1] & number[2:] & (doc[:-2] == doc[2:])) if len(doc) > 2 else np.zeros(0, np.int64)
    found[row] = True
    return found


def regions(column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """Text number, start and end of stretches around signals: ``REACH`` words to either side, joined where they meet."""
    strange = pc.match_substring_regex(column, f"[{_OTHER_DIGITS}]")
    for row, data, offsets in tb.chunks(column):
        start, end, doc = tb.words(data, offsets)
        if not len(doc):
            continue
        found = _signals(data, start, end, doc)
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        for k in np.flatnonzero(strange[row : row + len(offsets) - 1].fill_null(False).to_numpy(zero_copy_only=False)):
            at = [points[offsets[k]] + m.start() for m in _OTHER_DIGIT.finditer(column[row + k].as_py())]
            found[np.searchsorted(start, np.searchsorted(points, at, "right") - 1, "right") - 1] = True
        bounds = np.searchsorted(doc, np.arange(len(offsets)))
        word = np.flatnonzero(found)
        low, high = np.maximum(word - REACH, bounds[doc[word]]), np.minimum(word + REACH, bounds[doc[word] + 1] - 1)
        opens = np.flatnonzero(np.append(True, low[1:] > high[:-1])) if len(word) else word
        shuts = np.append(opens[1:], len(word)) - 1 if len(word) else word
        base = points[offsets[:-1]]
        own = doc[word[opens]]
        yield from zip((row + own).tolist(), (points[start[low[opens]]] - base[own]).tolist(), (points[end[high[shuts]]] - base[own]).tolist())

_CLASSES = "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "_" if c.isspace() else c for c in map(chr, range(128)))


@lru_cache(1 << 12)
def _class(c: str) -> str:
    return "9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "_" if c.isspace() else "o" if c.isalpha() else c


@lru_cache(1 << 16)
def _shape(classes: str) -> str:
    """Runs of one class as one sign each."""
    return "".join(c for c, before in zip(classes, "\0" + classes) if c != before)[:16]


def _spans(text: str, marks: list[tuple[int, int]]) -> Iterator[list[tuple]]:
    """For each first token what tells the spans from it on apart: of one token, of two, and so on."""
    low, n = marks[0][0], len(marks)
    region = text[low : marks[-1][1]]
    classes = region.translate(_CLASSES) if region.isascii() else "".join(map(_class, region))
    words = [text[a:z] for a, z in marks]
    own = [classes[a - low : z - low] for a, z in marks]
    digits, letters, dots = [0], [0], [0]
    for c, w in zip(own, words):
        digits.append(digits[-1] + c.count("9"))
        letters.append(letters[-1] + c.count("a") + c.count("A") + c.count("o"))
        dots.append(dots[-1] + w.count("."))
    gaps = [0]
    for k in range(n - 1):
        gaps.append(gaps[-1] + (marks[k][1] < marks[k + 1][0]))
    marked = _AT.search(region) is not None
    for i in range(n):
        before = [w.lower() for w in words[max(0, i - 3) : i]]
        after = any(w in _KEYWORDS for w in before) and any(w in ("=", ":") for w in before)
        kind = ("a" if words[i - 1].isalpha() else _shape(own[i - 1][:40])) if i else None
        a, row = marks[i][0], []
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            if j == i + 1 and words[i].isalpha():
                row.append(("word", after, kind))
                continue
            z = marks[j - 1][1]
            count, s = digits[j] - digits[i], text[a:z]
            luhn_ok = 12 <= count <= 19 and luhn("".join(c for c in s if c in "0123456789") or "1")
            row.append((
                _shape(classes[a - low : min(z, a + 40) - low]), min(count, 20), j - i, min(dots[j] - dots[i], 5), min(letters[j] - letters[i], 12),
                own[i][0], own[j - 1][-1], gaps[j - 1] > gaps[i], (_DOT.search(s) is not None if _AT.search(s) else None) if marked else None,
                luhn_ok, count >= 4 and _octets(s), 9 <= count <= 15 and count + sum(c in "+().- " for c in s) == len(s),
                j == i + 1 and len(s) >= 16 and 0 < count < len(s) and s.isalnum(), after, kind,
            ))
        yield row


def _octets(s: str) -> bool:
    parts = [p.strip() for p in re.split(r"[.:]| dot ", s)]
    return len(parts) == 4 and all(p.isdecimal() and int(p[:6]) <= 255 for p in parts)


def _features(key: tuple) -> list[str]:
    """Of the whole span that a key of :func:`_spans` stands for."""
    if key[0] == "word":
        found = ["word"]
    else:
        shape, digits, size, dots, letters, first, last, gap, at, luhn_ok, octets, dial, mixed = key[:13]
        found = [f"shape={shape}", f"digits={digits}", f"tokens={size}", f"dots={dots}", f"letters={letters}", f"first={first}", f"last={last}", f"gap={gap}"]
        found += [f"at={at}"] * (at is not None) + ["luhn"] * luhn_ok + ["octets"] * octets + [f"dial={first == '+'}"] * dial + ["mixed"] * mixed
    if key[-2]:
        found.append("after key")
    if key[-1] is not None:
        found.append("before=" + key[-1])
    return found


class Model:
    """Weights by feature and kind (0 is no entity), and of a kind following a kind."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, follow: np.ndarray):
        self.names, self.weights, self.follow = names, weights, follow
        self.sums: dict[tuple, np.ndarray] = {}  # of the finished model, by what tells spans apart

    def scores(self, ids: list[list[list[int]]]) -> np.ndarray:
        """For each first token and length the score of each kind; longer spans than one are never "no entity"."""
        kinds = self.weights.shape[1]
        out = np.full((len(ids), LONGEST, kinds), -np.inf)
        for i, row in enumerate(ids):
            for k, own in enumerate(row):
                out[i, k] = self.weights[own].sum(axis=0) if own else 0.0
                if k:
                    out[i, k, 0] = -np.inf
        return out

    def look_up(self, text: str, marks: list[tuple[int, int]], add: bool = False) -> list[list[list[int]]]:
        out = []
        for keys in _spans(text, marks):
            row = []
            for key in keys:
                found = _features(key)
                if add:
                    for f in found:
                        self.names.setdefault(f, len(self.names))
                row.append([self.names[f] for f in found if f in self.names])
            out.append(row)
        return out

    def decode(self, text: str, marks: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Start, kind number and end of the spans of the best segmentation."""
        n = len(marks)
        if not n or not self.names:
            return []
        kinds = self.weights.shape[1]
        scores = np.full((n, LONGEST, kinds), -np.inf)
        for i, keys in enumerate(_spans(text, marks)):
            for k, key in enumerate(keys):
                known = self.sums.get(key)
                if known is None:
                    if len(self.sums) >= SUMS:
                        self.sums.clear()
                    own = [self.names[f] for f in _features(key) if f in self.names]
                    known = self.sums[key] = self.weights[own].sum(axis=0) if own else np.zeros(kinds)
                scores[i, k] = known
        scores[:, 1:, 0] = -np.inf
        best = np.full((n + 1, kinds), -np.inf)
        best[0, 0] = 0.0
        entry, came = np.full((n + 1, kinds), -np.inf), np.zeros((n + 1, kinds), np.int32)
        back = np.zeros((n + 1, kinds, 2), np.int32)
        every, sizes = np.arange(kinds), np.arange(LONGEST)
        for end in range(n + 1):
            if end:
                k = sizes[: min(LONGEST, end)]
                start = end - k - 1
                value = entry[start] + scores[start, k]
                first = value.argmax(axis=0)
                best[end] = value[first, every]
                back[end, :, 0], back[end, :, 1] = start[first], came[start[first], every]
            total = best[end][:, None] + self.follow
            came[end] = total.argmax(axis=0)
            entry[end] = total[came[end], every]
        found, end, kind = [], n, int(best[n].argmax())
        while end > 0:
            start, came = back[end, kind]
            if kind:
                found.append((marks[start][0], kind - 1, marks[end - 1][1]))
            end, kind = int(start), int(came)
        return found[::-1]


def _log_sum(x: np.ndarray, axis=None) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = ROUNDS) -> Model:
    """Maximum likelihood by adaptive gradient steps; ``examples`` are texts and their spans."""
    kinds = len(KINDS) + 1
    model, ready = Model({}, np.zeros((0, kinds)), np.zeros((kinds, kinds))), []
    for text, spans in examples:
        marks = tokens(text, 0, len(text))
        opens, shuts = {a: i for i, (a, _) in enumerate(marks)}, {z: i for i, (_, z) in enumerate(marks)}
        gold, at, fits = [], 0, True
        for a, kind, z in spans:
            fits &= a in opens and z in shuts and at <= opens.get(a, -1) and 0 <= shuts.get(z, -9) - opens.get(a, 0) < LONGEST
            if fits:
                gold += [(i, 0, 0) for i in range(at, opens[a])] + [(opens[a], shuts[z] - opens[a], kind + 1)]
                at = shuts[z] + 1
        if fits and marks:
            ready.append((model.look_up(text, marks, add=True), gold + [(i, 0, 0) for i in range(at, len(marks))]))
    model.weights = np.zeros((len(model.names), kinds))
    squares, follow_squares = np.full_like(model.weights, 1e-2), np.full_like(model.follow, 1e-2)
    for _ in range(rounds):
        for ids, gold in ready:
            scores, n = model.scores(ids), len(ids)
            ahead = np.full((n + 1, kinds), -np.inf)
            ahead[0, 0] = 0.0
            for end in range(1, n + 1):
                own = [_log_sum(ahead[end - k - 1][:, None] + model.follow, 0) + scores[end - k - 1, k] for k in range(min(LONGEST, end))]
                ahead[end] = _log_sum(np.stack(own), 0)
            behind = np.full((n + 1, kinds), -np.inf)
            behind[n] = 0.0
            slope, follow_slope = np.zeros_like(model.weights), np.zeros_like(model.follow)
            total = _log_sum(ahead[n], 0)
            for start in range(n - 1, -1, -1):
                rest = np.stack([scores[start, k] + behind[start + k + 1] for k in range(min(LONGEST, n - start))])
                behind[start] = _log_sum(model.follow[None] + _log_sum(rest, 0)[None, None, :], 2)[0]
                into = ahead[start][:, None] + model.follow
                share = np.exp(into[None] + rest[:, None, :] - total)
                follow_slope -= share.sum(axis=0)
                for k, row in enumerate(share.sum(axis=1)):
                    np.add.at(slope, ids[start][k], -row)
            before = 0
            for start, k, kind in gold:
                np.add.at(slope[:, kind], ids[start][k], 1.0)
                follow_slope[before, kind] += 1
                before = kind
            slope -= DECAY * model.weights
            squares += slope**2
            follow_squares += follow_slope**2
            model.weights += RATE * slope / np.sqrt(squares)
            model.follow += RATE * follow_slope / np.sqrt(follow_squares)
    return model


def labelled(text: str) -> list[tuple[int, int, int]]:
    """What rules and key patterns say of a region; overlaps go to the first."""
    found = base_spans(text)
    for m in _SECRET.finditer(text):
        a = m.start() + len(m.group()) - len(m.group().lstrip(' \t\n"'))
        found.append((a, 4, m.end()))
    kept, end = [], 0
    for a, kind, z in sorted(found, key=lambda s: (s[0], -s[2])):
        if a >= end:
            kept.append((a, kind, z))
            end = z
    return kept


_LETTERS = str.maketrans("0123456789", "abcdefghij")
# Other spellings of the two marks in an email.
AT = (" at ", "(at)", " AT ", "[at]", "＠", " (at) ")
DOT = (" dot ", " DOT ", "(dot)")


def respelled(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The same text with its spans written another way."""
    out, new, at = [], [], 0
    for a, kind, z in spans:
        s = text[a:z]
        if kind == 0:
            s = s.replace("@", AT[turn % len(AT)])
            s = s if turn % 3 else s.replace(".", DOT[turn // 3 % len(DOT)])
            if len(tokens(s, 0, len(s))) > LONGEST:
                s = text[a:z].replace("@", AT[turn % len(AT)])
        elif kind == 2:
            digits = re.sub(r"[^0-9]", "", s)
            s = (".", "/")[turn % 2].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        elif kind == 3:
            s = re.sub(r"^\+\s*|[() ]+", lambda m: "" if m.start() == 0 else "-", s)
        elif kind == 4 and turn % 2:
            s = s.translate(_LETTERS)
        out += [text[at:a], s]
        start = sum(map(len, out)) - len(s)
        new.append((start, kind, start + len(s)))
        at = z
    return "".join([*out, text[at:]]), new


def lettered(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The same text with letters for digits outside of other spans; every other turn with emails of two-part domains."""
    out, new, at = [], [], 0
    for a, kind, z in spans:
        s = text[a:z]
        if kind == 0:
            name, domain = s.translate(_LETTERS).split("@")
            s = f"{name}@{'.'.join(domain.split('.')[-2:]) if turn // 2 % 2 else domain}"
        out += [text[at:a].translate(_LETTERS), s]
        start = sum(map(len, out)) - len(s)
        new.append((start, kind, start + len(s)))
        at = z
    return "".join([*out, text[at:].translate(_LETTERS)]), new


def train(docs: DataFrame, text: str = "text") -> Model:
    """A model from the regions with the least hashes, half of them with no other signal than a word."""

    def find(batches):
        for batch in batches:
            bodies, sides = batch.column("text"), {False: set(), True: set()}
            at, body = -1, ""
            for row, a, z in regions(bodies):
                if z - a <= 40 * REGION_TOKENS:
                    at, body = row, body if row == at else bodies[row].as_py()
                    sides[not _STRONG.search(body, a, z)].add(body[a:z])
            rows = []
            for weak, own in sides.items():
                rows += [(h, r, weak) for h, r in sorted((hashlib.md5(r.encode()).digest()[:8], r) for r in own)[:REGIONS]]
            yield pa.record_batch(
                {"h": pa.array([r[0] for r in rows], pa.binary()), "region": pa.array([r[1] for r in rows], pa.string()),
                 "weak": pa.array([r[2] for r in rows], pa.bool_())}
            )

    found = freeze(docs.select(F.col(text).alias("text")).mapInArrow(find, "h binary, region string, weak boolean"))
    chosen = []
    for weak in (False, True):
        own = found.filter(F.col("weak") == weak).orderBy("h", "region").limit(2 * REGIONS).collect()
        chosen += list(dict.fromkeys(r.region for r in own))[:REGIONS]
    examples = []
    for turn, region in enumerate(chosen):
        if len(tokens(region, 0, len(region))) <= REGION_TOKENS:
            spans = labelled(region)
            examples.append((region, spans))
            if any(kind != 1 for _, kind, _ in spans):
                examples.append(respelled(region, spans, turn))
            if any(kind == 0 for _, kind, _ in spans):  # a multiple of three respells the dots
                examples += [respelled(*lettered(region, spans, turn), t) for t in (turn, 3 * turn, 3 * turn + 3, 3 * turn + 6)]
    return fit(examples)


def all_spans(column: pa.Array, model: Model) -> Iterator[tuple[list, list]]:
    """For every text the spans of the rules, and these together with those the model adds."""
    found: dict[int, list[tuple[int, int]]] = {}
    for row, a, z in regions(column):
        found.setdefault(row, []).append((a, z))
    for row, value in enumerate(column):
        text = value.as_py() or ""
        base, added = base_spans(text), []
        for a, z in found.get(row, ()):
            for span in model.decode(text, tokens(text, a, z)):
                if not any(span[0] < e and s < span[2] for s, _, e in base):
                    added.append(span)
        yield base, sorted(base + added)


_SPANS = "array<struct<start: int, kind: string, end: int>>"


def find_spans(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``spans``, both arrays of (start, kind, end)."""
    model = model or train(docs, text)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training set
    kind = docs.schema[doc_id].dataType.simpleString()
    array = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def search(batches):
        for batch in batches:
            both = list(all_spans(batch.column("text"), held.value))
            named = [[[{"start": a, "kind": KINDS[k], "end": z} for a, k, z in side] for side in pair] for pair in both]
            yield pa.record_batch(
                {"id": batch.column("id"), "base": pa.array([n[0] for n in named], array), "spans": pa.array([n[1] for n in named], array)}
            )

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(search, f"id {kind}, base {_SPANS}, spans {_SPANS}").withColumnRenamed("id", doc_id)


def mask(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are replaced together, named by the first."""
    held = docs.sparkSession.sparkContext.broadcast(model or train(docs, text))

    def clean(body: str | None, spans: list) -> str | None:
        out, at = [], 0
        for a, kind, z in spans:
            if a >= at:
                out += [body[at:a], f"[{KINDS[kind].upper()}]"]
            at = max(at, z)
        return "".join([*out, body[at:]]) if spans else body

    names, place = docs.columns, docs.columns.index(text)

    def replace(batches):
        for batch in batches:
            told = all_spans(batch.column(place), held.value)
            new = pa.array([clean(x.as_py(), spans) for x, (_, spans) in zip(batch.column(place), told)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], new, *batch.columns[place + 1 :]], names=names)

    return docs.mapInArrow(replace, docs.schema)
