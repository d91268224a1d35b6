"""Personal data: a semi-Markov conditional random field over candidate windows.

Base spans come from one pattern per kind with a check (parts of an address,
check digits, number of digits). The model adds spans that no pattern states:
addresses written out ("name (at) host dot org"), numbers in other layouts,
account and identity numbers. It scores whole segments: their shape, check
digits, length, and the words around them. A dynamic programme of bounded
entity length chooses boundaries and kinds of a window together. Parameters are
fitted on generated sentences by exact likelihood, with a fixed seed.

A segment with fewer than seven digits and no at sign in any form can't be an
entity, so that between windows the best path is `other` throughout: decoding
windows one by one gives the decoding of the whole text, whatever its length.

Spans are in code points, end exclusive. A null text counts as empty and has
none. Repeated rows are scanned one by one; an empty table gives an empty
result; only doc_id, text and the columns to carry are read, so that other
names can't clash. Of segmentations with equal scores the one with fewer
entities stands, then the one whose last entity begins first. Spans of the
model that touch a base span are dropped; base spans always stay.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .frames import documents, per_block

KINDS = ("email", "ip", "card", "phone")
#: Kinds of the model, the base kinds first.
LABELS = (*KINDS, "iban", "ssn")
#: Most atoms and characters in an entity.
ATOMS, CHARS = 24, 60

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each at sign, so that long runs of letters cost nothing."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by kind and then by start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CHAIN.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PLUS.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


# ---- the model

ATOM = re.compile(r"[^\W\d_]+|[0-9]+|[^\S\n]+|.", re.S)
#: Written-out forms of the at sign and of dots.
AT = re.compile(r"[\[({<] ?at ?[\])}>]|@| at ", re.I | re.A)
WRITTEN = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:[\[({<] ?(?:at|@) ?[\])}>]| at |@) ?[A-Za-z0-9-]+(?: ?(?:[\[({<] ?(?:dot|\.) ?[\])}>]| dot |\.) ?[A-Za-z0-9-]+)+", re.I | re.A)
CUES = {
    "email": {"mail", "email", "contact", "write", "address"},
    "ip": {"ip", "host", "server", "address", "client", "from"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "cc"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp", "ring"},
    "iban": {"iban", "account", "bank", "transfer"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
}
TRIGGER = np.zeros(256, bool)
TRIGGER[0x30:0x3A] = TRIGGER[ord("@")] = True
#: At signs written as words: in brackets, or bare with what an address must have after them.
SPOKEN = r"[\[({<] ?at ?[\])}>]| at (?= ?[A-Za-z0-9-]+ ?(?:[\[({<] ?(?:dot|\.) ?[\])}>]| dot |\.) ?[A-Za-z0-9-])"
BRACKETED = re.compile(SPOKEN.encode(), re.I)
MARKS = re.compile(r"[0-9]{2,}|@|" + SPOKEN, re.I | re.A)
DIGIT = re.compile("[0-9]")


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(text: str, a: int, b: int, cues: frozenset[str]) -> list[str]:
    """Whole-segment features of text[a:b]."""
    s = text[a:b]
    d = only_digits(s)
    out = [f"n{min(len(d), 20)}", f"len{min((b - a) // 4, 12)}"]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "9", s)))
    out.append("shape:" + shape[:24])
    if re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", s):
        out.append("quad" + ("+" if all(len(p) < 4 and int(p) < 256 for p in s.split(".")) else "-"))
    if 13 <= len(d) <= 19 and re.fullmatch(r"[0-9](?:[ .-]?[0-9])+", s):
        out.append("luhn" + "-+"[luhn(d)])
    if re.fullmatch(r"\(?\+?[0-9][0-9 ().-]*[0-9]", s) and 7 <= len(d) <= 15:
        out += ["dial", "dial-sep" if len(s) > len(d) + 1 else "dial-run", "plus" if "+" in s[:2] else "no-plus"]
    if re.fullmatch(r"(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", s):
        out.append("dial-334")
    if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", s):
        out.append("3-2-4" + ("-" if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else "+"))
    if iban_valid(s):
        out.append("mod97")
    if WRITTEN.fullmatch(s):
        out.append("mail-form")
        out.append("mail-plain" if "@" in s else "mail-bracket" if re.search(r"[\[({<]", s) else "mail-words")
    if a and text[a - 1].isalnum() or b < len(text) and text[b : b + 1].isalnum():
        out.append("glued")
    if b < len(text) and text[b] in ".-" and text[b + 1 : b + 2].isdigit() or a > 1 and text[a - 1] in ".-+(" and (text[a - 2].isdigit() or text[a - 1] in "+("):
        out.append("cut")
    for kind in cues:
        out.append("cue:" + kind)
    return out


def cues_before(text: str, a: int) -> frozenset[str]:
    words = set(re.findall(r"[a-z]+", text[max(0, a - 24) : a].lower())[-3:])
    return frozenset(k for k, own in CUES.items() if words & own)


def candidates(text: str, lo: int, hi: int) -> tuple[list[int], dict[int, list[tuple[int, list[str]]]]]:
    """Edges of the window's atoms, and by the index of its last edge each segment that may be an entity, with its features."""
    edges = [lo, *(m.end() for m in ATOM.finditer(text, lo, hi))]
    ending: dict[int, list[tuple[int, list[str]]]] = {}
    for i in range(len(edges) - 1):
        a = edges[i]
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        cues = None
        for j in range(i + 1, min(len(edges), i + ATOMS + 1)):
            b = edges[j]
            if b - a > CHARS or text[b - 1] == "\n":
                break
            if not text[b - 1].isalnum() or b - a < 7:
                continue
            s = text[a:b]
            if not (sum("0" <= c <= "9" for c in s) >= 7 or AT.search(s) and WRITTEN.fullmatch(s)):
                continue
            if cues is None:
                cues = cues_before(text, a)
            ending.setdefault(j, []).append((i, features(text, a, b, cues)))
    return edges, ending


class SemiMarkov:
    """Scores of segments: one weight for each feature and label, and a bias for each label. `other` has the score 0."""

    def __init__(self, weights: dict[tuple[str, str], float]):
        self.weights = weights

    def score(self, found: list[str], label: str) -> float:
        w = self.weights
        return w.get(("bias", label), -2.0) + sum(w.get((f, label), 0.0) for f in found)

    def decode(self, text: str, lo: int, hi: int) -> list[tuple[str, int, int]]:
        """The best segmentation of text[lo:hi]: its entities."""
        edges, ending = candidates(text, lo, hi)
        best, back = [0.0] * len(edges), [None] * len(edges)
        for j in range(1, len(edges)):
            best[j], back[j] = best[j - 1], None
            for i, found in ending.get(j, ()):
                for label in LABELS:
                    v = best[i] + self.score(found, label)
                    if v > best[j]:
                        best[j], back[j] = v, (i, label)
        out, j = [], len(edges) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, label = back[j]
                out.append((label, edges[i], edges[j]))
                j = i
        return out[::-1]

    def expectations(self, text: str, gold: list[tuple[str, int, int]]) -> dict[tuple[str, str], float]:
        """Gradient of the log-likelihood of the gold entities: observed less expected features (forward-backward over segments)."""
        edges, ending = candidates(text, 0, len(text))
        n = len(edges)
        scored = [(i, j, found, label, self.score(found, label)) for j, own in ending.items() for i, found in own for label in LABELS]
        into, outof = [[] for _ in range(n)], [[] for _ in range(n)]
        for k, (i, j, *_) in enumerate(scored):
            into[j].append(k)
            outof[i].append(k)
        forward, backward = np.zeros(n), np.zeros(n)
        for j in range(1, n):
            forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[scored[k][0]] + scored[k][4] for k in into[j])])
        for i in range(n - 2, -1, -1):
            backward[i] = np.logaddexp.reduce([backward[i + 1], *(backward[scored[k][1]] + scored[k][4] for k in outof[i])])
        total, change = forward[-1], {}
        right = {(a, b): label for label, a, b in gold}
        for i, j, found, label, score in scored:
            p = float(np.exp(forward[i] + score + backward[j] - total))
            g = (right.get((edges[i], edges[j])) == label) - p
            if abs(g) > 1e-4:
                for f in ("bias", *found):
                    change[f, label] = change.get((f, label), 0.0) + g
        return change


def _check_digit(body: str) -> str:
    return next(c for c in "0123456789" if luhn(body + c))


def example(r: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A generated sentence and its entities."""
    word = lambda: "".join(r.choice(["re", "an", "ti", "der", "ou", "es", "lo", "che", "ing"]) for _ in range(r.randint(1, 3)))
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name, host = f"{word()}{r.choice(['', '.', '_'])}{word()}{r.choice(['', digits(2)])}", f"{word()}{r.choice(['', digits(1)])}"
    top = r.choice(["com", "org", "net", "de", "fr", "es"])
    kind = r.choice(["email", "email", "ip", "card", "phone", "phone", "iban", "ssn", "none", "none", "none", "none"])
    cue = r.choice([*CUES.get(kind, {word()}), word(), word()])
    cue = sorted(CUES.get(kind, {word()}))[r.randrange(len(CUES.get(kind, {1})))] if r.random() < 0.6 else cue
    if kind == "email":
        s = r.choice([f"{name}@{host}.{top}", f"{name} (at) {host} (dot) {top}", f"{name} [at] {host} [dot] {top}", f"{name}[at]{host}.{top}", f"{name} at {host} dot {top}"])
    elif kind == "ip":
        s = ".".join(str(r.randint(0, 255)) for _ in range(4))
    elif kind == "card":
        body = r.choice("3456") + digits(r.choice([14, 14, 13]))
        body += _check_digit(body)
        sep = r.choice(["", " ", "-", "."])
        s = sep.join(body[i : i + 4] for i in range(0, len(body), 4))
    elif kind == "phone":
        area, mid, end = digits(3), digits(3), digits(4)
        s = r.choice([f"+1 ({area}) {mid}-{end}", f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"+{digits(2)} {digits(3)} {digits(6)}", f"+{digits(11)}"])
    elif kind == "iban":
        land, body = r.choice(["DE", "FR", "ES"]), digits(18)
        check = next(c for c in (f"{k:02d}" for k in range(2, 99)) if iban_valid(land + c + body))
        s = land + check + body
        s = " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if r.random() < 0.5 else s
    elif kind == "ssn":
        s = f"{r.randint(1, 665):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}"
    else:
        s = r.choice([digits(r.randint(7, 22)), f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}.{digits(4)}", f"{digits(1)},{digits(3)},{digits(3)}", f"token = \"{''.join(r.choice('0123456789abcdef') for _ in range(32))}\"", f"v{digits(1)}.{digits(2)}.{digits(3)}.{digits(5)}", f"{digits(4)} {digits(4)} {digits(3)}", f"{word()} at {word()} {word()}", f"@{word()}", f"{digits(3)}.{digits(8)}", f"{300 + r.randrange(600)}.{digits(3)}.{digits(3)}.{digits(3)}", f"{word()}={digits(9)}ab{digits(8)}"])
    lead = " ".join(word() for _ in range(r.randint(0, 3)))
    lead = f"{lead} {cue}{r.choice([' ', ': '])}" if lead or kind != "none" else ""
    tail = r.choice(["", ".", ",", f" {word()} {word()}.", f" {word()}", f". {word()}"])
    return lead + s + tail, [] if kind == "none" else [(kind, len(lead), len(lead) + len(s))]


@lru_cache(maxsize=2)
def fitted(examples: int = 400, rounds: int = 4, seed: int = 7) -> SemiMarkov:
    """Fit by stochastic gradient ascent (steps by the sum of squares), with a pull towards zero."""
    r = random.Random(seed)
    data = [example(r) for _ in range(examples)]
    weights: dict[tuple[str, str], float] = {("bias", label): -3.0 for label in LABELS}
    squares: dict[tuple[str, str], float] = {}
    model = SemiMarkov(weights)
    for _ in range(rounds):
        for text, gold in data:
            for key, g in model.expectations(text, gold).items():
                g -= 0.002 * weights.get(key, 0.0)
                squares[key] = squares.get(key, 0.0) + g * g
                weights[key] = weights.get(key, 0.0) + 0.5 * g / (0.1 + squares[key] ** 0.5)
        r.shuffle(data)
    return model


def model_windows(text: str) -> list[tuple[int, int]]:
    """Windows outside of which no entity of the model can lie."""
    digits = [m.start() for m in DIGIT.finditer(text)]
    spaced = [a for a, b in zip(digits, digits[6:], strict=False) if b - a < CHARS]
    marks = sorted({*(m.start() for m in MARKS.finditer(text)), *spaced})
    out: list[list[int]] = []
    for m in marks:
        a, b = max(0, m - CHARS), min(len(text), m + CHARS)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    whole = []
    for a, b in out:  # windows begin and end between words
        while a and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        while b < len(text) and text[b].isalnum() and text[b - 1].isalnum():
            b += 1
        whole.append((a, b))
    return whole


def all_spans(text: str, model: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans; all spans, by kind in the order of LABELS and then by start."""
    base = base_spans(text)
    taken = np.array(sorted((a, b) for _, a, b in base), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
    extra = set()
    for lo, hi in model_windows(text):
        for label, a, b in model.decode(text, lo, hi):
            k = int(np.searchsorted(taken[:, 0], b))  # base spans that begin before b
            if not k or reach[k - 1] <= a:
                extra.add((label, a, b))
    merged = sorted([*base, *extra], key=lambda s: (LABELS.index(s[0]), s[1], s[2]))
    return base, merged


def find(docs: DataFrame, schema: str, derive, *carry: str, model: SemiMarkov | None = None) -> DataFrame:
    """Scan whole texts and keep what `derive` makes of them.

    derive(text, base, spans) gets a text and its spans, or (None, [], []) for
    a text that can hold none; it returns the values of `schema`'s columns,
    which follow doc_id and the columns named in carry.
    """
    fit = model or fitted()
    taken = documents(docs, *carry)
    kept = [f for f in taken.schema if f.name != "text"]
    names = [c.split()[0] for c in schema.split(", ")]

    def work(block, rows):
        hits = np.flatnonzero(TRIGGER[block.bytes])
        marked = set(np.unique(block.rows_of(hits)).tolist()) | {int(block.rows_of(np.array([m.start()]))[0]) for m in BRACKETED.finditer(block.raw)}
        made = []
        for i in range(block.n):
            text = block.text(i).decode()
            made.append(derive(text, *(all_spans(text, fit) if i in marked else ([], []))))
        return {f.name: rows.column(i) for i, f in enumerate(rows.schema) if f.name != "text"} | {n: [m[k] for m in made] for k, n in enumerate(names)}

    return per_block(taken, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [schema]), work)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first is."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]
