"""Text helpers as column expressions (all run inside the JVM)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolefit import vocab

# Unicode whitespace, spelled out because \s covers only ASCII blanks in Java regexes.
WS_RANGES = [(0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
             (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
_WS_CLASS = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in WS_RANGES)
WS, NOT_WS = f"[{_WS_CLASS}]", f"[^{_WS_CLASS}]"
WS_CHARS = "".join(chr(c) for lo, hi in WS_RANGES for c in range(lo, hi + 1))
KEY_CHARS = 120
# Private mark placed at word boundaries, see mark_words().
MARK = "\u0001"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False)) if conditions else F.lit(False)


def quoted(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip_ws(c: Column) -> Column:
    """Strip every kind of whitespace at both ends (``trim`` strips spaces only)."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+", " ")


def strip_html(c: Column) -> Column:
    """Tags become one space each, then both ends are stripped."""
    return strip_ws(F.regexp_replace(c, r"<[^>]+>", " "))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike("(?i)" + pattern)


def cued_match(text: str, lowered: str, pattern: str, cues: list[str]) -> str:
    """SQL for a case-insensitive match that runs only on texts holding one of the cue words.

    ``lowered`` names the lower-cased text. A byte search is far cheaper than a regex pass, and
    few texts hold a given cue.
    """
    found = f"{text} RLIKE {quoted('(?i)' + pattern)}"
    if not cues:
        return found
    return f"(({' OR '.join(f'contains({lowered}, {quoted(cue)})' for cue in cues)}) AND {found})"


def mark_words(c: Column) -> Column:
    """Lower-case text with a mark at each word boundary.

    Matching many whole words against one text then needs one regex pass over the text and a
    plain ``contains`` per word, instead of one regex per word (and, when the words come from
    another table, one regex compilation per row).
    """
    return F.regexp_replace(F.lower(c), r"\b", MARK)


def word_needle(c: Column) -> Column:
    """What to search in mark_words() output so that it equals a ``\\bword\\b`` search."""
    inner = F.regexp_replace(F.regexp_replace(F.lower(c), r"\b", MARK), f"^{MARK}|{MARK}$", "")
    return F.concat(F.lit(MARK), inner, F.lit(MARK))


def marked_word(word: str) -> str:
    """word_needle() of a fixed word."""
    return MARK + re.sub(f"^{MARK}|{MARK}$", "", re.sub(r"\b", MARK, word.lower())) + MARK


def content_key(title: Column, company: Column, location: Column, description: Column) -> Column:
    """16 hex digits identifying a posting by what it says; reposts share it.

    The key reads the first characters of the lower-cased description with whitespace collapsed.
    A run of whitespace counts as one character there, so the stretch of text that can matter is
    cut out first and long descriptions are not rewritten as a whole. One more character than
    needed is taken because lower-casing may look at the next one.
    """
    stretch = F.regexp_extract(description, f"^(?:{NOT_WS}|{WS}++){{0,{KEY_CHARS + 1}}}+", 0)
    prefix = F.substring(collapse_ws(F.lower(stretch)), 1, KEY_CHARS)
    return F.substring(
        F.md5(F.concat_ws("|", F.lower(title), F.lower(company), F.lower(location), prefix)), 1, 16
    )


def norm_title(c: Column) -> Column:
    out = F.lower(F.coalesce(c, F.lit("")))
    for pattern, replacement in vocab.TITLE_FOLDS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def title_tokens(c: Column) -> Column:
    return F.regexp_extract_all(norm_title(c), F.lit(r"[a-z0-9+#]+"), F.lit(0))


def distinctive_tokens(c: Column) -> Column:
    """Title tokens that are not generic, or all tokens when only generic ones are left.

    Duplicates stay: they count in the share of matched tokens.
    """
    tokens = title_tokens(c)
    kept = F.filter(tokens, lambda t: ~t.isin(vocab.GENERIC_TITLE_TOKENS))
    return F.when(F.size(kept) > 0, kept).otherwise(tokens)


def word_tokens(c: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def url_quote_plus(c: Column) -> Column:
    """Form encoding that keeps ``~`` and escapes ``*``."""
    encoded = F.url_encode(c)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def pretty_skill(c: Column) -> Column:
    """Title case for names longer than three characters, else upper case.

    Title case starts a new word after every character that is not a letter.
    """
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}]+|[^\p{L}]+"), F.lit(0))
    titled = F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")
    return F.when(F.length(c) > 3, titled).otherwise(F.upper(c))
