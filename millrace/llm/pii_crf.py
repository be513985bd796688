"""Personal data: fixed patterns plus a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field reads white-space words by the shape of their characters
and by the word before, is trained on a small labelled table (`labelled_table`, made by rule; another
can be given), and adds what the patterns do not know: phone numbers without a plus sign, cards with
other separators, written-out at signs, numbers of a card's form that fail its check sum (`account`),
and keys, tokens and passwords (`secret`). Added spans never touch a base span.

Decoding is Viterbi over numpy batches of runs. A word without a digit or an at sign (a plain word)
has one emission, learned as all others are. Where its lead for O exceeds what transitions can gain,
one or two such words in a row (`gap`) are O on the best path whatever stands beside them, so that
the runs between them are decoded alone, exactly. Otherwise whole texts are decoded.

Null and empty texts have no spans. Very long texts and words are linear in their length: every
pattern is anchored so that a failed start is not tried again inside the same run, and shapes are
read from whole words. Repeated rows each have a row; ties between labels go to the first as listed.
An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import lean, need

#: The kinds, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Further kinds, which only the field gives; they are listed after those.
MORE_KINDS = ("account", "secret")
LABELS = ("O", *KINDS, "secret")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\S+")
_MARKED = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def good_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def good_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def good_phone(text: str, least: int = 9) -> bool:
    return least <= len(_NOT_DIGIT.sub("", text)) <= 15


def _emails(text: str):
    """Leftmost matches, found from their at signs: the run of local characters before one, a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        if (m := _DOMAIN.match(text, at)) is not None:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    if not text or not _ANY.search(text):
        return []
    out = [(a, b, 0) for a, b in _emails(text)]
    out += [(*m.span(), 1) for m in _IP.finditer(text) if good_ip(m.group())]
    out += [(*m.span(), 2) for m in _CARD.finditer(text) if m.end() - m.start() >= 12 and good_card(m.group())]
    out += [(*m.span(), 3) for m in _PHONE.finditer(text) if good_phone(m.group())]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


# ---- the labelled table


def labelled_table(seed: int = 11, rows: int = 700) -> list[tuple[list[str], list[str]]]:
    """Words and labels of short lines made by rule: personal data in many formats, and other numbers."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    syllables = "an er on the lo mi ra te vo ki da su".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def plain() -> str:
        w = word()
        w = rng.choice((w, w, w, w.capitalize(), w.upper(), f'"{w}"', f"({w})"))
        return w + rng.choice(("", "", "", "", ".", ",", "!", "?", ":", ";"))

    def email() -> list[str]:
        local = rng.choice((word(), f"{word()}.{word()}", f"{word()}.{num(2)}", f"{word()}_{num(3)}"))
        host = rng.choice((f"{word()}.com", f"mail{num(1)}.{word()}.org", f"{word()}.co.uk"))
        return [local + rng.choice(("@", "@", "[at]", "(at)")) + host]

    def ip() -> list[str]:
        own = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        return [own + rng.choice(("", "", f":{num(4)}", "/24"))]

    def card() -> list[str]:
        g = [num(4) for _ in range(4)]
        return rng.choice(([f"{''.join(g)}"], g, ["-".join(g)], [".".join(g)], [g[0], num(6), num(5)], [num(15)]))

    def phone() -> list[str]:
        a, b, c = num(3), num(3), num(4)
        return rng.choice((
            [f"+{num(1)}", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"({a}){b}-{c}"], [f"({a})", f"{b}.{c}"], [f"{a}-{b}-{c}"], [f"{a}.{b}.{c}"],
            [f"+{num(2)}", num(2), num(7)], [f"+{num(2)}", num(3), num(4), num(4)], [f"+{num(11)}"], [f"1-{a}-{b}-{c}"], [f"+{num(1)}-{a}-{b}-{c}"],
        ))

    def key(alphabet: str, k: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(k))

    low, up, digits, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"

    def value() -> str:
        return rng.choice((key(hexes, 32), key(hexes, 40), key(hexes, 40), key(hexes.upper(), 40), key(hexes, 64), key(low + digits, rng.randint(16, 40)), key(low + up + digits, rng.randint(16, 44)), f"sk-{key(low + up + digits, 32)}", f"ghp_{key(low + up + digits, 36)}", f"AKIA{key(up + digits, 16)}"))

    def name() -> str:
        return rng.choice(("token", "Token", "TOKEN", "key", "api_key", "secret", "password", "passwd", "auth", "credential"))

    def secret() -> tuple[list[str], list[str]]:
        quoted = rng.choice(('"{}"', '"{}"', "'{}'", "{}")).format(value())
        named = rng.choice(([name(), "=", quoted], [name(), "=", quoted], [f"{name()}:", quoted], [f"{name()}=", quoted], [f"{name()}={quoted}"], [name(), "is", quoted]))
        return named, ["O"] * (len(named) - 1) + ["secret"]

    def other() -> list[str]:
        return rng.choice((
            [num(1)], [num(2)], [num(3)], [num(4)], [num(5)], [num(6)], [num(7)], [num(8)], [num(9)], [num(10)], [num(10)], [num(11)], [num(13)], [num(22)], [f"{num(2)},{num(3)}"], [f"{num(1)}.{num(2)}"],
            [f"{num(1)}.{num(1)}.{num(1)}"], [f"v{num(1)}.{num(1)}.{num(2)}"], [f"{num(4)}-{num(2)}-{num(2)}"], [f"{num(2)}/{num(2)}/{num(4)}"],
            [f"{num(2)}:{num(2)}"], [f"{num(2)}%"], [f"${num(3)}"], [f"{num(2)}-{num(2)}"], [f"@{word()}"], [f"{word()}{num(2)}"], [f"{word()}={num(2)}{word()}{num(3)}{word()}"],
            [f"http://{word()}.com/{num(3)}"], [f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}"], [f"({num(4)})"], [f"[{num(1)}]"], [f"({num(1)})"], [f"({num(3)})", word()],
            [num(2), num(2), num(3)], [num(4), num(4)], [num(3), num(3)], [f"AK{num(2)}XZ{num(1)}QW"], [word(), "=", num(4)], [word(), "=", f"{num(1)}.{num(2)}"], [word(), "=", f'"{word()}{num(1)}"'],
            ["commit", key(hexes, 40)], ["commit", key(hexes, 7)], [word(), key(hexes, 40)], ["sha1", key(hexes, 40)], ["md5", key(hexes, 32)], ["isbn", f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}"], [rng.choice(("id", "uuid", word())), rng.choice(("=", ":")), f"{key(hexes, 8)}-{key(hexes, 4)}-{key(hexes, 4)}-{key(hexes, 4)}-{key(hexes, 12)}"], [f"{key(hexes, 8)}-{key(hexes, 4)}-{key(hexes, 4)}-{key(hexes, 4)}-{key(hexes, 12)}"], [f"#{key(hexes, 6)}"], [f"0x{key(hexes, 8)}"],
        ))

    table = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.randint(2, 4)):
            for _ in range(rng.randint(0, 4)):
                words.append(plain())
                labels.append("O")
            kind = rng.choice(("email", "ip", "card", "phone", "phone", "secret", "O", "O", "O", "O"))
            own, named = secret() if kind == "secret" else ((x := {"email": email, "ip": ip, "card": card, "phone": phone, "O": other}[kind]()), [kind] * len(x))
            words += own[:-1] + [own[-1] + rng.choice(("", "", "", ".", ",", "!!", "###", "%%%"))]
            labels += named
            if rng.random() < 0.75:
                words.append(plain())
                labels.append("O")
        table.append((words, labels))
    return table


# ---- features, training, decoding

_RUN = re.compile(r"[0-9]+|[a-z]+|[A-Z]+|[^\x00-\x7f]+|.", re.S)
PLAIN = ("plain",)
#: What stands around a value and is no part of it.
BEFORE, AFTER = "\"'<{", ".,;:!?\"'>}#$%&*|"
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_LETTERS = re.compile(r"[a-z]+")
#: Runs of one kind of character that a shape lists one by one; a word of more is only said to have many.
RUNS = 16
#: Times that a feature is in the labelled table at least, to have weights.
LEAST_TIMES = 3
#: Words and features that are kept, and the length of a word up to which they are.
KEPT, SHORT = 5_000, 64


def is_plain(word: str) -> bool:
    return not _MARKED.search(word)


def features(word: str, before: str) -> tuple[str, ...]:
    """Names of the shape features of a word after another. Plain words all have the same."""
    if is_plain(word):
        return PLAIN
    return (*_shape(word), *_context(before)) if len(word) > SHORT else (*_kept_shape(word), *_context(before))


def _context(before: str) -> tuple[str, ...]:
    """The last letters of the word before, and the sign it ends with."""
    if not before:
        return ("first",)
    if not is_plain(before[:SHORT]):
        return ("after marked",)
    found = _LETTERS.findall(before[-SHORT:].lower())
    return (f"after {found[-1] if found else ''}", f"sign {before[-1] if before[-1] in '=:' else ''}")


def _shape(word: str) -> tuple[str, ...]:
    core = word.lstrip(BEFORE).rstrip(AFTER)
    exact, loose, digits, letters, runs, last = [], [], 0, 0, 0, ""
    for m in _RUN.finditer(core):
        c, runs = m.group(), runs + 1
        if c[0].isdigit() and c.isascii():
            kind, shape, digits = "d", f"d{min(len(c), 20)}", digits + len(c)
        elif c.isalpha():
            kind, shape, letters = "x", "x", letters + len(c)
        else:
            kind = shape = c if len(c) == 1 else "?"
        if runs <= RUNS:
            exact.append(shape)
            loose += [kind] if kind != last else []
        last = kind
    many = "many" if runs > RUNS else ""
    size = next(k for k, most in enumerate((0, 1, 2, 3, 4, 6, 9, 11, 19, 1 << 60)) if digits <= most)
    width = next(k for k, most in enumerate((6, 12, 15, 24, 48, 80, 1 << 60)) if len(core) <= most)
    assigned = core.find("=")
    tail = core[assigned + 1 :].lstrip(BEFORE) if assigned > 0 else core
    kind = ("hex" if _HEX.fullmatch(tail) else "alnum") if tail.replace("_", "").replace("-", "").isalnum() and digits and letters else "none"
    named = _LETTERS.findall(core[:assigned].lower())[-1:] if assigned > 0 else []
    return (
        "marked", f"exact {many or ' '.join(exact)}", f"loose {many or ' '.join(loose)}", f"digits {size}", f"dots {min(core.count('.'), 5)}", f"at {'@' in core}", f"first {(loose or [''])[0]}",
        f"letters {letters > 0}", f"width {width}", f"mixed {kind} {width}", *(f"named {n}" for n in named),
    )


@lru_cache(maxsize=KEPT)
def _kept_shape(word: str) -> tuple[str, ...]:
    return _shape(word)


def _forget() -> None:
    """Gives back what a task has kept; workers are used again by other tasks."""
    _kept_shape.cache_clear()


class Field:
    """Weights: of each feature for each label, and of each label after each."""

    def __init__(self, weights: dict[str, np.ndarray], moves: np.ndarray):
        self.weights, self.moves, self.cache = weights, moves, {}
        #: Plain words in a row that are all O on every best path whatever stands around them: 1, 2, or 0 where that is not sure.
        self.gap = self._gap(self.emission("plain", ""))

    def _gap(self, plain: np.ndarray) -> int:
        """By what the labels of a stretch of plain words can gain in transitions, against what O leads by in each word."""
        m, every = self.moves, range(len(LABELS))
        lead = float(plain[0] - plain[1:].max())
        gain = {(a, b): max(float(m[a, y] + m[y, b] - m[a, 0] - m[0, b]) for y in every[1:]) for a in every for b in every}
        into = max(float(m[a, y] - m[a, 0]) for a in every for y in every[1:])
        out_of = max(float(m[y, b] - m[0, b]) for b in every for y in every[1:])
        among = max(float(m[y, z] - m[0, 0]) for y in every[1:] for z in every[1:])
        if lead <= max(0.0, into, out_of, among):
            return 0
        if lead > max(gain.values()):
            return 1
        beside_o = max(g for (a, b), g in gain.items() if a == 0 or b == 0)
        return 2 if lead > beside_o and 2 * lead > into + out_of + max(0.0, among) else 0

    def emission(self, word: str, before: str) -> np.ndarray:
        own = features(word, before)
        out = self.cache.get(own)
        if out is None:
            out = sum((self.weights[f] for f in own if f in self.weights), np.zeros(len(LABELS)))
            if len(self.cache) >= KEPT:
                self.cache.clear()
            self.cache[own] = out
        return out

    @staticmethod
    def train(table, steps: int = 160, rate: float = 0.3, decay: float = 1e-5) -> Field:
        """Maximum likelihood by Adam over the whole table, forward and backward sums in logs."""
        befores = [["", *words[:-1]] for words, _ in table]
        times = Counter(f for (words, _), before in zip(table, befores, strict=True) for w, b in zip(words, before, strict=True) for f in features(w, b))
        names = sorted(f for f, n in times.items() if n >= LEAST_TIMES)
        at = {f: i for i, f in enumerate(names)}
        rows, steps_of, width = len(table), max(len(w) for w, _ in table), len(LABELS)
        lengths = np.array([len(w) for w, _ in table])
        gold = np.zeros((rows, steps_of), dtype=np.int64)
        kinds: dict[tuple, int] = {}  # words of the same features count together
        kind = np.zeros((rows, steps_of), dtype=np.int64)
        for r, (words, labels) in enumerate(table):
            for t, (w, y) in enumerate(zip(words, labels, strict=True)):
                gold[r, t] = LABELS.index(y)
                kind[r, t] = kinds.setdefault(features(w, befores[r][t]), len(kinds))
        present = np.zeros((len(kinds), len(names)))
        for own, k in kinds.items():
            present[k, [at[f] for f in own if f in at]] = 1
        mask = np.arange(steps_of)[None, :] < lengths[:, None]
        theta = np.zeros((len(names) + width, width))
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        seen = np.zeros((rows * steps_of, width))
        seen[np.arange(rows * steps_of), gold.ravel()] = 1
        seen *= mask.ravel()[:, None]
        seen = seen.reshape(rows, steps_of, width)
        pairs = np.zeros((width, width))
        both = mask[:, 1:]
        np.add.at(pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)

        def total(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        for step in range(1, steps + 1):
            w, moves = theta[: len(names)], theta[len(names) :]
            emit = (present @ w)[kind]
            ahead, back = np.zeros_like(emit), np.zeros_like(emit)
            ahead[:, 0] = emit[:, 0]
            for t in range(1, steps_of):
                new = emit[:, t] + total(ahead[:, t - 1][:, :, None] + moves[None], 1)
                ahead[:, t] = np.where(mask[:, t][:, None], new, ahead[:, t - 1])
            for t in range(steps_of - 2, -1, -1):
                new = total(moves[None] + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2)
                back[:, t] = np.where(mask[:, t + 1][:, None], new, 0.0)
            z = total(ahead[:, -1], 1)
            chance = np.exp(ahead + back - z[:, None, None]) * mask[:, :, None]
            grad = np.zeros_like(theta)
            by_kind = [np.bincount(kind.ravel(), (seen - chance)[:, :, y].ravel(), len(kinds)) for y in range(width)]
            grad[: len(names)] = present.T @ np.stack(by_kind, axis=1)
            joint = np.exp(ahead[:, :-1][:, :, :, None] + moves[None, None] + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - z[:, None, None, None]) * both[:, :, None, None]
            grad[len(names) :] = pairs - joint.sum(axis=(0, 1))
            grad = grad / rows - decay * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return Field({f: theta[i].copy() for f, i in at.items()}, theta[len(names) :].copy())

    def viterbi(self, runs: list[list[tuple[str, str]]]) -> list[np.ndarray]:
        """The best labels of each run of words, given with the word before each. Runs of like length are decoded together."""
        out: list = [None] * len(runs)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        at = 0
        while at < len(order):
            longest = max(1, len(runs[order[at]]))
            many = [order[at]]
            while at + len(many) < len(order) and len(runs[order[at + len(many)]]) <= max(4, 2 * longest) and len(many) < 4096:
                many.append(order[at + len(many)])
            at += len(many)
            steps = max(len(runs[i]) for i in many)
            emit = np.zeros((len(many), steps, len(LABELS)))
            lengths = np.array([len(runs[i]) for i in many])
            for r, i in enumerate(many):
                for t, (w, before) in enumerate(runs[i]):
                    emit[r, t] = self.emission(w, before)
            score, back = emit[:, 0].copy(), np.zeros((len(many), steps, len(LABELS)), dtype=np.int8)
            for t in range(1, steps):
                options = score[:, :, None] + self.moves[None]
                back[:, t] = options.argmax(axis=1)
                new = options.max(axis=1) + emit[:, t]
                score = np.where((t < lengths)[:, None], new, score)
            label = score.argmax(axis=1)
            path = np.zeros((len(many), steps), dtype=np.int8)
            for t in range(steps - 1, -1, -1):
                label = np.where(t < lengths, label, label)
                path[:, t] = label
                inside = t < lengths
                label = np.where(inside, back[np.arange(len(many)), t, label], label) if t else label
            for r, i in enumerate(many):
                out[i] = path[r, : lengths[r]]
        return out


def runs_of(text: str, gap: int) -> list[list[tuple[int, int, int, int]]]:
    """Runs of neighbouring words to decode, each word as its place and that of the word before.

    Marked words with less than `gap` plain ones between them are in one run, which has a plain word
    at both ends if there is one, as transitions from and to it count. Without a gap: all words.
    """
    if not text or not (_ANY.search(text) or "at]" in text.lower() or "at)" in text.lower()):
        return []
    out, own, plain, before = [], [], 0, (0, 0)
    last = None  # the word before, if it is plain
    for m in _WORD.finditer(text):
        here = (*m.span(), *before)
        before = m.span()
        if not gap or _MARKED.search(text, *before):
            if own and gap and plain >= gap:
                out.append(own[: len(own) - gap + 1])
                own = []
            own += [*([last] if not own and last is not None else []), here]
            plain, last = 0, None
        else:
            last = here
            if own and plain < gap:
                own.append(here)
            plain += 1
    if own:
        out.append(own)
    return out


def _spans_of(text: str, words: list[tuple[int, int, int, int]], labels: np.ndarray) -> list[tuple[int, int, str]]:
    """Labelled words as spans: neighbouring words of one card or phone number together, without the punctuation around."""
    found, k = [], 0
    while k < len(words):
        kind, j = int(labels[k]), k + 1
        if kind == 0:
            k = j
            continue
        joins = LABELS[kind] in ("card", "phone")
        while joins and j < len(words) and labels[j] == kind and words[j][2] == words[j - 1][0] and not (LABELS[kind] == "phone" and text[words[j][0]] in "+(" and text[words[j - 1][0]] != "+"):
            j += 1
        for a, b in [(words[k][0], words[j - 1][1])] if joins else [words[i][:2] for i in range(k, j)]:
            a, b = _trimmed(text, a, b, LABELS[kind])
            if b > a:
                found.append((a, b, _kind_of(text[a:b], LABELS[kind])))
        k = j
    return [x for x in found if x[2]]


def _trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """A span without the marks around it; a secret without its name too."""
    while a < b and text[a] in BEFORE + "[,;:":
        a += 1
    while a < b and text[b - 1] in AFTER + "]":
        b -= 1
    if a < b and text[b - 1] == ")" and "(" not in text[a:b]:
        b -= 1
    if a < b and text[a] == "(" and ")" not in text[a:b]:
        a += 1
    if kind == "secret" and 0 < (at := text.find("=", a, b)) < b - 1:
        a = at + 1
        while a < b and text[a] in BEFORE:
            a += 1
    return a, b


def _kind_of(own: str, kind: str) -> str | None:
    """The kind that a labelled span is given out as: what cannot be one by its digits is none, a card that fails its sum an account."""
    digits = _NOT_DIGIT.sub("", own)
    if kind == "email":
        return kind if re.search(r"\w(?:@|[\[(]at[\])])\w", own, re.I) else None
    if kind == "ip":
        return kind if good_ip(".".join(re.findall("[0-9]+", own)[:4])) else None
    if kind == "card":
        return (kind if luhn(digits) else "account") if 12 <= len(digits) <= 19 else None
    if kind == "phone":
        return kind if 10 <= len(digits) <= 15 else None
    return kind if len(own) >= 8 else None


def find(texts: list[str | None], field: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t or "") for t in texts]
    runs, owner = [], []
    for i, t in enumerate(texts):
        for own in runs_of(t or "", field.gap):
            runs.append(own)
            owner.append(i)
    labels = field.viterbi([[(texts[i][a:b], texts[i][c:d]) for a, b, c, d in own] for i, own in zip(owner, runs, strict=True)])
    more: dict[int, list] = {}
    for i, own, path in zip(owner, runs, labels, strict=True):
        if path.any():
            more.setdefault(i, []).extend(_spans_of(texts[i], own, path))
    order = (*KINDS, *MORE_KINDS)
    out = []
    for i, own in enumerate(base):
        free = apart(more.get(i, []), own)
        out.append((own, sorted(own + free, key=lambda s: (s[0], order.index(s[2]), s[1])) if free else own))
    return out


def apart(spans: list, others: list) -> list:
    """Those of the spans that touch none of the others."""
    if not others:
        return sorted(spans)
    starts, ends = [], []  # the others' union, as intervals apart from each other
    for a, b, _ in sorted(others):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return [x for x in sorted(spans) if (k := bisect_right(starts, x[1] - 1)) == 0 or ends[k - 1] <= x[0]]


def written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redacted(text: str | None, spans) -> str | None:
    """The text with each group of overlapping spans replaced by the kind of its first."""
    if not spans:
        return text
    out, done, at = [], 0, 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = done = max(done, b)
    return "".join([*out, text[at:]])


@lru_cache(maxsize=1)
def trained() -> Field:
    return Field.train(labelled_table())


def _scan(held, redact: bool):
    def run(batches):
        field = Field(*held.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                texts = part.column(part.num_columns - 1).to_pylist()
                found = find(texts, field)
                columns = [*part.columns[:-1]]
                if redact:
                    columns.append(pa.array([redacted(t, s) for t, (_, s) in zip(texts, found, strict=True)], pa.string()))
                columns += [pa.array([sum(x[2] == kind for x in b) for b, _ in found], pa.int64()) for kind in KINDS]
                columns.append(pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string()))
                columns.append(pa.array([written(s) for _, s in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[: -1 if not redact else None], *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
        _forget()

    return run


def labelled_rows(spark: SparkSession) -> DataFrame:
    """The labelled table as a DataFrame: words array<string>, labels array<string>."""
    return spark.createDataFrame(labelled_table(), "words array<string>, labels array<string>")


def scan(docs: DataFrame, keep: list[str], redact: bool = False, labelled: DataFrame | None = None) -> DataFrame:
    """The columns `keep` of docs, the text with spans replaced if asked for, counts by kind of the base spans, their hash, and all spans.

    labelled: another table (words, labels) to train on; it is read whole, so it must be small.
    """
    field = trained() if labelled is None else Field.train(sorted((list(r["words"]), list(r["labels"])) for r in labelled.select("words", "labels").collect()))
    held = docs.sparkSession.sparkContext.broadcast((field.weights, field.moves))
    rows = need(docs, *keep, "text")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if redact or f.name != "text")
    return rows.mapInArrow(lean(_scan(held, redact)), f"{kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
