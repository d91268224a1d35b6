"""Text as columns: normal forms, sets of bigrams and tokens, and the families of similarity.

The builders take columns that are NFKC already (see nfkc()); canonicalising
once at ingestion keeps everything after it inside the JVM. They are null-safe:
null counts as the empty text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as in Unicode, the word characters of tokens, everything but letters and digits of compact forms, CJK ideographs.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
TOKEN = r"[\x{4E00}-\x{9FFF}A-Za-z0-9_]+"
NOT_COMPACT = r"[^0-9a-z\x{4E00}-\x{9FFF}]+"
CJK = r"[\x{4E00}-\x{9FFF}]"
TITLE_PREFIX = r"(?i)^(?:[\x{56FE}\x{8868}]\s*[0-9]+|(?:figure|table|chart)\s*[0-9]+)\s*[:\x{FF1A}.\x{FF0E}\-]?\s*"
#: Texts of these characters are their own NFKC form.
STABLE = r"^[\x00-\x7F\x{C0}-\x{FF}\x{4E00}-\x{9FFF}]*$"


def nfkc(text: Column) -> Column:
    """The NFKC form; Python sees only texts that could change."""
    import pandas as pd

    @F.pandas_udf("string")
    def form(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return F.coalesce(form(F.when(~text.rlike(STABLE), text)), text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once, however often it is used (within lambdas too)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(blank(text), f"^{SPACE}|{SPACE}$", "")


def compare_form(text: Column) -> Column:
    """White space collapsed and stripped, lower case."""
    return F.lower(F.trim(F.regexp_replace(blank(text), SPACE, " ")))


def squash_form(text: Column) -> Column:
    """White space removed, lower case."""
    return F.lower(F.regexp_replace(blank(text), SPACE, ""))


def compact_form(text: Column) -> Column:
    """Lower-case letters, digits and ideographs only."""
    return F.regexp_replace(squash_form(text), NOT_COMPACT, "")


def strip_title_prefix(text: Column) -> Column:
    return F.regexp_replace(strip(text), TITLE_PREFIX, "")


def has_cjk(text: Column) -> Column:
    return blank(text).rlike(CJK)


def bigrams(form: Column) -> Column:
    """Distinct pairs of neighbouring characters; a single character is a set of its own."""
    # Overlapping matches of a look-ahead: one pass over the text, whatever its characters' widths.
    pairs = F.regexp_extract_all(form, F.lit("(?s)(?=(..))"), F.lit(1))
    return F.array_distinct(F.when(F.length(form) == 1, F.array(form)).otherwise(pairs))


def characters(form: Column) -> Column:
    return F.array_distinct(F.filter(F.split(form, ""), lambda c: c != ""))


def tokens(form: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(form, F.lit(TOKEN), F.lit(0)))


def jaccard(a: Column, b: Column, both_empty: float = 0.0) -> Column:
    """Shared elements among all; two empty sets give `both_empty`."""
    # Of sets, the union has as many elements as both less the shared ones. The division is null for two empty sets.
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(both_empty))


def contained(a: Column, b: Column) -> Column:
    """Whether either of two non-empty texts holds the other."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))


def prepared(text: Column) -> Column:
    """Everything the similarities need of a text, computed once before a self-join."""
    parts = lambda form, squash, bare: F.struct(form.alias("form"), squash.alias("squash"), F.regexp_replace(squash, NOT_COMPACT, "").alias("compact"), bigrams(form).alias("grams"), tokens(form).alias("words"), bare.alias("bare"), compare_form(bare).alias("bare_form"))
    return let(compare_form(text), lambda form: let(squash_form(text), lambda squash: let(strip_title_prefix(text), lambda bare: parts(form, squash, bare))))


# ---- similarities of prepared texts


def text_similarity(a: Column, b: Column) -> Column:
    """Bigram Jaccard; a blank text is like nothing."""
    return F.when((a.form == "") | (b.form == ""), 0.0).when(a.form == b.form, 1.0).otherwise(jaccard(a.grams, b.grams))


def keyword_similarity(a: Column, b: Column) -> Column:
    return jaccard(a.words, b.words)


def _blanks(a: Column, b: Column) -> Column:
    return F.when((a == "") & (b == ""), 0.5).when((a == "") | (b == ""), 0.0)


def field_similarity(a: Column, b: Column) -> Column:
    """As text_similarity, but two blank fields half agree."""
    return _blanks(a.form, b.form).otherwise(text_similarity(a, b))


def field_match(a: Column, b: Column) -> Column:
    return _blanks(a.form, b.form).otherwise((a.form == b.form).cast("double"))


def phrase_similarity(a: Column, b: Column) -> Column:
    """The best of containment, bigrams, and keywords with bigrams."""
    inside = F.when(contained(a.compact, b.compact), 0.45 + 0.5 * length_ratio(a.compact, b.compact)).otherwise(0.0)
    best = let(text_similarity(a, b), lambda chars: F.greatest(inside, 0.6 * keyword_similarity(a, b) + 0.4 * chars, chars))
    return F.when((a.form == "") | (b.form == ""), 0.0).when(a.form == b.form, 1.0).otherwise(best)


def title_similarity(a: Column, b: Column, a_bare: Column, b_bare: Column) -> Column:
    """Titles may differ in their numbered prefix; a_bare and b_bare are prepared without it (with it where nothing else is left)."""
    return _blanks(a.form, b.form).when(a.form == b.form, 1.0).when((a.bare_form != "") & (a.bare_form == b.bare_form),
        1.0).otherwise(phrase_similarity(a_bare, b_bare))


def bare_or_whole(text: Column) -> Column:
    return F.when(strip_title_prefix(text) != "", strip_title_prefix(text)).otherwise(blank(text))


def alignment_score(a: Column, b: Column) -> Column:
    """Containment decides by itself; otherwise keywords and bigrams."""
    best = let(text_similarity(a, b), lambda chars: F.greatest(0.6 * keyword_similarity(a, b) + 0.4 * chars, chars))
    return F.when((a.form == "") | (b.form == ""), 0.0).when(a.form == b.form, 1.0).when(contained(a.compact, b.compact),
        0.45 + 0.5 * length_ratio(a.compact, b.compact)).otherwise(best)


def evidence_prepared(text: Column) -> Column:
    """What evidence_similarity needs; tokens are taken before white space goes."""
    return let(squash_form(text), lambda squash: _evidence_parts(text, squash))


def _evidence_parts(text: Column, squash: Column) -> Column:
    return F.struct(squash.alias("squash"), F.regexp_replace(squash, NOT_COMPACT, "").alias("compact"), bigrams(squash).alias("grams"),
        tokens(F.lower(blank(text))).alias("words"), characters(squash).alias("chars"), has_cjk(text).alias("cjk"))


def evidence_similarity(a: Column, b: Column) -> Column:
    """Likeness of a claim and a piece of evidence: containment counts by the shorter length."""
    short, ratio = F.least(F.length(a.compact), F.length(b.compact)), length_ratio(a.compact, b.compact)
    inside = F.when(short <= 2, 0.25 + 0.25 * ratio).when(short <= 4, 0.45 + 0.2 * ratio).otherwise(0.65 + 0.25 * ratio)
    grams, words = jaccard(a.grams, b.grams, 1.0), jaccard(a.words, b.words, 1.0)  # of distinct elements
    return (
        F.when((a.squash == "") | (b.squash == ""), 0.0)
        .when(a.squash == b.squash, 1.0)
        .when(contained(a.compact, b.compact), inside)
        .when(a.cjk | b.cjk, F.greatest(grams, words, jaccard(a.chars, b.chars, 1.0)))
        .otherwise(F.greatest(words, grams))
    )


def vote_form(text: Column) -> Column:
    """The form in which texts vote: line breaks of either kind are spaces."""
    return compare_form(F.regexp_replace(blank(text), r"<br\s?/?>", " "))


def visible_score(text: Column) -> Column:
    """Characters in runs of letters, digits and a few signs."""
    return F.length(F.regexp_replace(vote_form(text), r"[^\x{4E00}-\x{9FFF}A-Za-z0-9\x{B1}/%\-()]+", ""))


def arrow_count(content: Column) -> Column:
    """Arrows of the three kinds in diagram text."""
    return F.regexp_count(blank(content), F.lit(r"-->|-\.->|==>"))
