"""SQL for DuckDB that says the same as the column builders; the oracle queries are made of these."""

from __future__ import annotations

SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
TOKEN = r"[\x{4E00}-\x{9FFF}A-Za-z0-9_]+"
NOT_COMPACT = r"[^0-9a-z\x{4E00}-\x{9FFF}]+"
PREFIX = r"(?i)^(?:[\x{56FE}\x{8868}]\s*[0-9]+|(?:figure|table|chart)\s*[0-9]+)\s*[:\x{FF1A}.\x{FF0E}\-]?\s*"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACE}|{SPACE}$', '', 'g')"


def form(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '{SPACE}', ' ', 'g'), ' '))"


def squash(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '{SPACE}', '', 'g'))"


def compact(x: str) -> str:
    return f"regexp_replace({squash(x)}, '{NOT_COMPACT}', '', 'g')"


def bare(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{PREFIX}', '')"


def grams(f: str) -> str:
    return f"""
        CASE WHEN {f} = '' THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(length({f}), 2)),
            lambda i: substr({f}, i, 2))) END
    """


def words(f: str) -> str:
    return f"list_distinct(regexp_extract_all({f}, '{TOKEN}'))"


def jaccard(a: str, b: str, empty: float = 0.0) -> str:
    both = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {both} = 0 THEN {empty} ELSE len(list_intersect({a}, {b})) / {both} END"


def contained(a: str, b: str) -> str:
    return f"({a} <> '' AND {b} <> '' AND (contains({a}, {b}) OR contains({b}, {a})))"


def ratio(a: str, b: str) -> str:
    return f"(least(length({a}), length({b})) / greatest(length({a}), length({b})))"


def prepared(x: str, n: str) -> str:
    """Columns n_form, n_compact, n_bare, n_bf of a text; n_grams and n_words come from these (see more())."""
    return f"{form(x)} AS {n}_form, {compact(x)} AS {n}_compact, {bare(x)} AS {n}_bare, {form(bare(x))} AS {n}_bf"


def more(n: str) -> str:
    return f"{grams(n + '_form')} AS {n}_grams, {words(n + '_form')} AS {n}_words"


def text_sim(a: str, b: str) -> str:
    return f"""
        CASE WHEN {a}_form = '' OR {b}_form = '' THEN 0.0 WHEN {a}_form = {b}_form THEN 1.0 ELSE {jaccard(a + '_grams', b + '_grams')} END
    """


def keyword_sim(a: str, b: str) -> str:
    return jaccard(a + "_words", b + "_words")


def blanks(a: str, b: str, rest: str) -> str:
    return f"CASE WHEN {a}_form = '' AND {b}_form = '' THEN 0.5 WHEN {a}_form = '' OR {b}_form = '' THEN 0.0 ELSE {rest} END"


def phrase_sim(a: str, b: str) -> str:
    inside = f"CASE WHEN {contained(a + '_compact', b + '_compact')} THEN 0.45 + 0.5 * {ratio(a + '_compact', b + '_compact')} ELSE 0.0 END"
    chars = f"({text_sim(a, b)})"
    return f"""
        CASE WHEN {a}_form = '' OR {b}_form = '' THEN 0.0 WHEN {a}_form = {b}_form THEN 1.0 ELSE greatest({inside},
          0.6 * ({keyword_sim(a, b)}) + 0.4 * {chars}, {chars}) END
    """


def title_sim(a: str, b: str, a2: str, b2: str) -> str:
    return blanks(a, b, f"CASE WHEN {a}_form = {b}_form THEN 1.0 WHEN {a}_bf <> '' AND {a}_bf = {b}_bf THEN 1.0 ELSE ({phrase_sim(a2, b2)}) END")


def align_sim(a: str, b: str) -> str:
    chars = f"({text_sim(a, b)})"
    return f"""
        CASE WHEN {a}_form = '' OR {b}_form = '' THEN 0.0 WHEN {a}_form = {b}_form THEN 1.0
        WHEN {contained(a + '_compact', b + '_compact')} THEN 0.45 + 0.5 * {ratio(a + '_compact', b + '_compact')}
        ELSE greatest(0.6 * ({keyword_sim(a, b)}) + 0.4 * {chars}, {chars}) END
    """


def evidence_sim(a: str, b: str) -> str:
    """Of columns *_squash, *_compact, *_grams and *_words; texts without ideographs."""
    short, r = f"least(length({a}_compact), length({b}_compact))", ratio(a + "_compact", b + "_compact")
    inside = f"CASE WHEN {short} <= 2 THEN 0.25 + 0.25 * {r} WHEN {short} <= 4 THEN 0.45 + 0.2 * {r} ELSE 0.65 + 0.25 * {r} END"
    return f"""
        CASE WHEN {a}_squash = '' OR {b}_squash = '' THEN 0.0 WHEN {a}_squash = {b}_squash THEN 1.0
        WHEN {contained(a + '_compact', b + '_compact')} THEN {inside} ELSE greatest({jaccard(a + '_words', b + '_words', 1.0)},
          {jaccard(a + '_grams', b + '_grams', 1.0)}) END
    """


def vote_form(x: str) -> str:
    return form(f"regexp_replace(coalesce({x}, ''), '<br\\s?/?>', ' ', 'g')")


def visible(x: str) -> str:
    return f"length(regexp_replace({vote_form(x)}, '[^\\x{{4E00}}-\\x{{9FFF}}A-Za-z0-9\\x{{B1}}/%\\-()]+', '', 'g'))"


LINES = r"regexp_split_to_array(coalesce({x}, ''), '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')"


def lines(x: str) -> str:
    return LINES.format(x=x)
