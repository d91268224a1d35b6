"""Rule bitmask ledger for document quality.

Every rule is evaluated once. A document's ledger row holds its measurements
and a bitmask with one bit per rule that it fails. Policies are versioned and
only read the ledger: a policy has a mask of rules that reject alone and a mask
of rules of which several must fail together. Ablations (what a policy would
keep without a rule) come from counts per bitmask, of which there are at most
2 ** rules, so no document is read again.

A null or empty text has no words: it fails `few_words`. Repeated rows are
judged one by one. An empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import documents, per_block
from .textcore import U64, WORD, mix, windows

#: The characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER, LETTER = np.zeros(256, bool), np.zeros(256, bool)
UPPER[0x41:0x5B] = LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
#: A rule's place is its bit. Each is an integer condition under which a document fails it.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "2 * n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("capitals", "n_letters >= 100 AND 10 * n_upper > 7 * n_letters"),
    ("some_repeats", "100 * n_repeat_words > 30 * n_words"),
    ("some_symbols", "4 * n_symbols > n_words"),
    ("some_duplicate_lines", "3 * n_dup_lines > n_lines"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


@dataclass(frozen=True)
class Policy:
    """Documents that fail a rule of `alone`, or at least `least` rules of `together`, go."""

    version: str
    alone: int
    together: int = 0
    least: int = 2

    def keeps(self, bits: Column) -> Column:
        return (bits.bitwiseAND(F.lit(self.alone)) == 0) & (F.bit_count(bits.bitwiseAND(F.lit(self.together))) < self.least)


BASE = mask("few_words", "repeated_windows")
POLICIES = {
    "1": Policy("1", BASE),
    "2": Policy("2", BASE | mask("symbols", "duplicate_lines", "short_words", "long_words", "capitals"), mask("some_repeats", "some_symbols", "some_duplicate_lines")),
}
CURRENT = "2"


def measure(docs: DataFrame, *carry: str, keep_text: bool = False) -> DataFrame:
    """All measurements of every document, from its whole text; columns named in carry stay, and the text on demand."""

    def work(block, rows):
        hashes, first, row = block.words(WORD)
        n_words = np.diff(first)
        at, key = windows(hashes, first, 3)
        _, inverse, count = np.unique(mix(key ^ (row[at].astype(U64) * U64(0xD6E8FEB86659FD93))), return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        hit = np.zeros(len(hashes) + 3, bool)
        for k in range(3):
            hit[twice + k] = True
        covered = np.concatenate(([0], np.cumsum(hit[: len(hashes)])))
        data = block.bytes
        word = WORD[data]
        seen = np.concatenate(([0], np.cumsum(word)))
        breaks = np.flatnonzero(data == 0x0A)
        edges = block.offsets
        starts = np.unique(np.concatenate((edges[:-1], breaks + 1)))
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))[: len(starts)]
        ends = ends - (data[np.maximum(ends - 1, 0)] == 0x0A) if len(ends) else ends
        real = seen[np.maximum(ends, starts)] > seen[starts]
        starts, ends = starts[real], ends[real]
        line_row = block.rows_of(starts)
        lines = np.bincount(line_row, minlength=block.n)
        keys = mix(block.hashes(starts, ends) ^ (line_row.astype(U64) * U64(0xD6E8FEB86659FD93)))
        _, once = np.unique(keys, return_index=True)
        values = {
            "n_words": n_words, "word_chars": block.sums(word & ((data & 0xC0) != 0x80)), "n_symbols": block.sums(SYMBOLS[data]), "n_dup_lines": lines - np.bincount(line_row[once], minlength=block.n),
            "n_repeat_words": covered[first[1:]] - covered[first[:-1]], "n_lines": lines, "n_upper": block.sums(UPPER[data]), "n_letters": block.sums(LETTER[data]),
        }
        return {f.name: rows.column(i) for i, f in enumerate(rows.schema) if keep_text or f.name != "text"} | values

    taken = documents(docs, *carry)
    kept = [f for f in taken.schema if keep_text or f.name != "text"]
    return per_block(taken, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{m} long" for m in MEASURES]), work)


def ledger(docs: DataFrame, *carry: str, keep_text: bool = False) -> DataFrame:
    """doc_id, the measurements and `bits`: every rule evaluated once."""
    bits = F.lit(0)
    for name, fails in RULES:
        bits = bits + F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0))
    return measure(docs, *carry, keep_text=keep_text).withColumn("bits", bits.cast("int"))


def judge(ledgered: DataFrame, policy: Policy | str = CURRENT) -> DataFrame:
    """Add base_failed and kept by a policy."""
    chosen = POLICIES[policy] if isinstance(policy, str) else policy
    failed = F.col("bits").bitwiseAND(F.lit(BASE)) != 0
    return ledgered.withColumn("base_failed", failed).withColumn("kept", ~failed & chosen.keeps(F.col("bits")))


def ablation(ledgered: DataFrame, policy: Policy | str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that are kept without it."""
    chosen = POLICIES[policy] if isinstance(policy, str) else policy
    counts = ledgered.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    rules = [(name, BIT[name]) for name, _ in RULES if BIT[name] & (chosen.alone | chosen.together)]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in rules])).alias("r")
    wide = counts.select("bits", "n", each).select("bits", "n", "r.rule", "r.bit")
    without = wide.withColumn("rest", F.col("bits") - F.col("bits").bitwiseAND(F.col("bit")))
    kept, kept_without = chosen.keeps(F.col("bits")), chosen.keeps(F.col("rest"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return without.groupBy("rule").agg(total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"), total(~kept & kept_without).alias("only"), total(kept_without).alias("kept_without"))
