"""License scan by ordered signature rules.

Over two hundred hand-written rules (license_notices.py), and rules made of
hand-written names with templates and identifiers, run over a text only if the
text holds the rule's keyword; texts without any keyword are passed over as a
block. Each rule has a priority. Detections are taken in order of priority,
then length, place and label; one that lies within the interval of a detection
already taken is suppressed. The intervals taken so far are kept as the
frontier of those that lie in no other, in order, so that a text full of
licenses costs no more than sorting its detections.

Words are runs of letters, digits and non-ASCII characters of the lower-cased
text. The base phrases are found wherever their words stand one after another.
A null or empty text has no words, no labels and the score 0. Texts are read
whole, however long. Repeated rows are scanned one by one, an empty table gives
an empty result, and columns other than doc_id and text aren't read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import documents, per_block
from .license_notices import notices
from .textcore import ALNUM

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: What separates two words, and the edges of a word.
GAP, LEFT, RIGHT = rb"[^0-9a-z\x80-\xff]+", rb"(?<![0-9a-z\x80-\xff])", rb"(?![0-9a-z\x80-\xff])"

#: label, ways to write the name (words; | between), SPDX identifiers
FAMILIES: tuple[tuple[str, str, str], ...] = (
    ("apache", "apache license|apache software license|asl", "apache-1.0 apache-1.1 apache-2.0"),
    ("mit", "mit license|expat license|mit x11 license", "mit mit-0"),
    ("bsd", "bsd license|berkeley software distribution license|new bsd license|simplified bsd license", "bsd-2-clause bsd-3-clause bsd-4-clause 0bsd"),
    ("gpl", "gnu general public license|gnu gpl|gpl", "gpl-1.0 gpl-2.0 gpl-3.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0-only gpl-3.0-or-later"),
    ("lgpl", "gnu lesser general public license|gnu library general public license|gnu lgpl|lgpl", "lgpl-2.0 lgpl-2.1 lgpl-3.0 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0-or-later"),
    ("agpl", "gnu affero general public license|affero general public license|agpl", "agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later"),
    ("gfdl", "gnu free documentation license|gfdl", "gfdl-1.1 gfdl-1.2 gfdl-1.3"),
    ("mpl", "mozilla public license|mpl", "mpl-1.0 mpl-1.1 mpl-2.0"),
    ("epl", "eclipse public license", "epl-1.0 epl-2.0"),
    ("cddl", "common development and distribution license|cddl", "cddl-1.0 cddl-1.1"),
    ("cpl", "common public license", "cpl-1.0"),
    ("eupl", "european union public licence|eupl", "eupl-1.1 eupl-1.2"),
    ("artistic", "artistic license|perl artistic license", "artistic-1.0 artistic-2.0"),
    ("isc", "isc license", "isc"),
    ("zlib", "zlib license|zlib libpng license", "zlib"),
    ("boost", "boost software license", "bsl-1.0"),
    ("unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license|wtfpl", "wtfpl"),
    ("python", "python software foundation license|psf license", "psf-2.0 python-2.0"),
    ("php", "php license", "php-3.0 php-3.01"),
    ("ofl", "sil open font license|open font license", "ofl-1.0 ofl-1.1"),
    ("odbl", "open database license|odc open database license", "odbl-1.0"),
    ("postgresql", "postgresql license", "postgresql"),
    ("ncsa", "university of illinois ncsa open source license|ncsa license", "ncsa"),
    ("openssl", "openssl license", "openssl"),
    ("cecill", "cecill license", "cecill-2.0 cecill-2.1 cecill-b cecill-c"),
    ("ms-pl", "microsoft public license", "ms-pl"),
    ("ms-rl", "microsoft reciprocal license", "ms-rl"),
    ("cc-by", "creative commons attribution license|creative commons attribution|cc by", "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0"),
    ("cc-by-sa", "creative commons attribution sharealike license|creative commons attribution sharealike|creative commons attribution share alike|cc by sa", "cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0"),
    ("cc-by-nc", "creative commons attribution noncommercial license|creative commons attribution noncommercial|cc by nc", "cc-by-nc-3.0 cc-by-nc-4.0"),
    ("cc-by-nd", "creative commons attribution noderivatives license|creative commons attribution noderivs|cc by nd", "cc-by-nd-3.0 cc-by-nd-4.0"),
    ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike|cc by nc sa", "cc-by-nc-sa-3.0 cc-by-nc-sa-4.0"),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives|cc by nc nd", "cc-by-nc-nd-3.0 cc-by-nc-nd-4.0"),
    ("cc0", "creative commons zero|cc0|cc0 public domain dedication", "cc0-1.0"),
)
#: template, priority (smaller first), confidence. N is the name, V a version.
TEMPLATES: tuple[tuple[str, int, float], ...] = (
    ("licensed under the N V", 10, 0.98),
    ("released under the N V", 10, 0.98),
    ("distributed under the N V", 10, 0.98),
    ("under the terms of the N V", 11, 0.97),
    ("N version V", 20, 0.9),
    ("N V", 30, 0.8),
)
@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern
    priority: int
    confidence: float


def phrase(words: str) -> bytes:
    """A pattern for words one after another; of words with strokes between them one, a word with a question mark perhaps, a number for #."""
    out, lead = LEFT, b""
    for w in words.split():
        maybe = w.endswith("?")
        each = b"|".join(re.escape(x).encode().replace(rb"\#", rb"[0-9]+(?:\.[0-9]+)*") for x in w.rstrip("?").split("/"))
        out += b"(?:" + lead + b"(?:" + each + b"))?" if maybe else lead + b"(?:" + each + b")"
        lead = GAP
    return out + RIGHT


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in order of priority."""
    made: list[Rule] = []
    version = rb"(?:" + GAP + rb"(?:version" + GAP + rb"|v" + GAP + rb"?)?[0-9]+(?:\.[0-9]+)*)?"
    for label, names, identifiers in FAMILIES:
        for name in names.split("|"):
            longest = max(name.split(), key=len)
            for template, priority, confidence in TEMPLATES:
                if "version V" in template and len(name.split()) < 2:
                    continue
                lead = template.split("N")[0].split()
                body = rb"".join(re.escape(w.encode()) + GAP for w in lead).replace(b"the" + GAP, b"(?:the" + GAP + b")?")
                core = GAP.join(re.escape(w.encode()) for w in name.split())
                tail = GAP + rb"version" + GAP + rb"[0-9]+(?:\.[0-9]+)*" if "version V" in template else version
                made.append(Rule(label, longest.encode(), re.compile(LEFT + body + core + tail + RIGHT), priority - min(len(name.split()), 6) / 10, confidence))
        for x in identifiers.split():
            made.append(Rule(label, b"spdx", re.compile(rb"spdx-license-identifier:[ \t]*" + re.escape(x.encode()) + rb"(?![0-9a-z.+-])"), 1, 1.0))
    for label, keyword, words, priority, confidence in notices():
        made.append(Rule(label, keyword.encode(), re.compile(phrase(words)), priority, confidence))
    return tuple(sorted(made, key=lambda r: r.priority))


@lru_cache(maxsize=1)
def by_keyword() -> dict[bytes, list[Rule]]:
    out: dict[bytes, list[Rule]] = {}
    for r in rules():
        out.setdefault(r.keyword, []).append(r)
    return out


@lru_cache(maxsize=1)
def anchors() -> list[bytes]:
    """Strings of which a text holds at least one if any rule or base phrase can match it."""
    return sorted({b"licen" if b"licen" in r.pattern.pattern else r.keyword for r in rules()} | {b"licen", b"cc"})


@lru_cache(maxsize=1)
def base_pattern() -> tuple[re.Pattern, dict[bytes, str]]:
    # Words of two phrases never overlap, so one alternation finds all places.
    body = b"|".join(b"(" + GAP.join(w.encode() for w in p.split()) + b")" for p in PHRASES)
    return re.compile(LEFT + b"(?:" + body + b")" + RIGHT), dict(enumerate(PHRASES.values(), 1))


def detect(lowered: bytes) -> list[tuple[str, int, int, float]]:
    """Detections in a lower-cased text that are not suppressed: label, first and last byte (exclusive), confidence."""
    found = []
    for keyword, own in by_keyword().items():
        if keyword in lowered:
            for r in own:
                found += [(r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.confidence) for m in r.pattern.finditer(lowered)]
    taken: list[tuple[str, int, int, float]] = []
    starts: list[int] = []  # of the frontier's intervals; their ends are in order too
    ends: list[int] = []
    for _, _, a, b, label, confidence in sorted(found):
        k = bisect_right(starts, a)
        if k and ends[k - 1] >= b:
            continue
        taken.append((label, a, b, confidence))
        lo, hi = bisect_left(starts, a), bisect_right(ends, b)
        starts[lo : max(lo, hi)], ends[lo : max(lo, hi)] = [a], [b]
    return taken


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base places (n_base, first_word, last_word, base_labels), labels of all detections, their spans in words, and a score."""

    def work(block, rows):
        low = block.lower()
        starts, _ = low.runs(ALNUM)
        first = np.searchsorted(starts, low.offsets)
        marked: set[int] = set()
        for a in anchors():
            at = low.raw.find(a)
            while at >= 0:
                row = int(low.rows_of(np.array([at]))[0])
                marked.add(row)
                at = low.raw.find(a, int(low.offsets[row + 1]))
        n_base = np.zeros(block.n, np.int64)
        lo, hi, base, labels, score, spans = [None] * block.n, [None] * block.n, [""] * block.n, [""] * block.n, np.zeros(block.n), [""] * block.n
        pattern, names = base_pattern()
        for row in marked:
            text = low.text(row)
            places = [(int(m.start()), names[m.lastindex]) for m in pattern.finditer(text)]
            found = detect(text)
            word = lambda p: int(np.searchsorted(starts, p + low.offsets[row])) - int(first[row])  # noqa: B023, E731
            if places:
                at = [word(p) for p, _ in places]
                n_base[row], lo[row], hi[row] = len(at), min(at), max(at)
                base[row] = ",".join(sorted({x for _, x in places}))
            labels[row] = ",".join(sorted({x for _, x in places} | {x for x, *_ in found}))
            score[row] = max([c for *_, c in found] + [0.8 for _ in places[:1]], default=0.0)
            spans[row] = ",".join(f"{x}:{word(a)}:{word(b)}" for x, a, b, _ in sorted(found, key=lambda f: f[1]))
        return {"doc_id": rows.column(0), "n_words": np.diff(first), "n_base": n_base, "first_word": pa.array(lo, pa.int64()), "last_word": pa.array(hi, pa.int64()), "base_labels": base, "labels": labels, "score": score, "spans": spans}

    return per_block(documents(docs), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string", work)
