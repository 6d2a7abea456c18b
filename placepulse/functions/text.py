"""Text functions. All take and return a Column; null in, null out.

Words and digits are spelled out as Unicode classes, and white space as the Unicode white space
plus the four separators U+001C..U+001F, because the regex shorthands of the JVM are ASCII-only.

Every pattern runs in time linear in the text: none starts a scan to the end of the text from
each character, so one very long token or one stray bracket cannot stall a task. Where a rule
needs a character that few texts have, a plain search for that character decides whether the
pattern runs at all.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, for use inside of brackets. SPACE needs the Unicode flag.
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
SPACE = r"\s\x1c-\x1f"
UNICODE = "(?U)"

# The patterns of the cleaning rules.
URL = r"https?://[a-z$-_!]+"
PHONE = (
    rf"{UNICODE}(?:\+?{DIGIT}{{1,4}}[-.{SPACE}]?)?\(?{DIGIT}{{1,3}}\)?"
    rf"[-.{SPACE}]?{DIGIT}{{1,4}}[-.{SPACE}]?{DIGIT}{{1,9}}"
)
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
NOT_KEPT = rf"""{UNICODE}[^{WORD}{SPACE}.,!?;:'"()-]"""
LINK_WORD = rf"{UNICODE}(?:http|www)[^{SPACE}]++"

# A word holding "@" after its first and before its last character goes as a whole.
AT_WORD = rf"{UNICODE}(?<![^{SPACE}])[^{SPACE}][^{SPACE}@]*+@[^{SPACE}]++"
# Ten or more digits with no word character on either side, tried from the first digit on.
LONG_NUMBER = rf"{DIGIT}(?<![{WORD}]{DIGIT}){DIGIT}{{9,}}+(?![{WORD}])"
# White space that is not already one plain space.
LOOSE_SPACE = rf"{UNICODE}[{SPACE}&&[^ ]][{SPACE}]*+| [{SPACE}]++"

# An address begins at the first word edge of a run of local-part characters; if no address
# begins there, none begins later in the same run. The run is therefore tried once, and what
# lies before its first edge is captured and put back.
_EDGE = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = (
    rf"(?:\G|(?<![{_LOCAL}]))"
    rf"(?:(?<=[{WORD}])([A-Za-z0-9_]++)|(?<![{WORD}])([.%+-]++)|{_EDGE})"
    rf"[{_LOCAL}]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{_EDGE}"
)

# Arithmetic of the Hangul syllable block.
_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
_LEADS = tuple(chr(0x1100 + i) for i in range(19))
_VOWELS = tuple(chr(0x1161 + i) for i in range(21))
_TAILS = ("",) + tuple(chr(0x11A8 + i) for i in range(27))


def _replace(c: Column, pattern: str, replacement: str = " ") -> Column:
    return F.regexp_replace(c, pattern, replacement)


def strip_html(c: Column) -> Column:
    """Tags become a space; entities and script bodies stay.

    Only the part up to the last ``>`` can hold a tag, so the rest is set aside unread.
    """
    tail = F.substring_index(c, ">", -1)
    head = F.left(c, F.length(c) - F.length(tail))
    return F.concat(_replace(head, "<[^>]+>"), tail)


def strip_urls(c: Column) -> Column:
    """http and https links become a space."""
    return _replace(c, URL)


def strip_emails(c: Column) -> Column:
    """Mail addresses become a space."""
    return _replace(c, EMAIL, "$1$2 ")


def strip_phones(c: Column) -> Column:
    """Phone numbers, in practice any run of three or more digits, become a space."""
    return _replace(c, PHONE)


def strip_social(c: Column) -> Column:
    """Mentions, then hashtags, become a space."""
    return _replace(_replace(c, MENTION), HASHTAG)


@cache
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Decomposition without non-spacing marks, from the Unicode database.

    Returns source and target of one ``translate`` call (sources beyond the target's length are
    deleted) and the few characters that decompose into several. Hangul is left to arithmetic.
    """
    pairs: list[tuple[str, str]] = []
    gone: list[str] = []
    several: list[tuple[str, str]] = []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        char = chr(code)
        folded = "".join(
            part for part in unicodedata.normalize("NFD", char) if unicodedata.category(part) != "Mn"
        )
        if folded == char:
            continue
        if len(folded) == 1:
            pairs.append((char, folded))
        elif folded:
            several.append((char, folded))
        else:
            gone.append(char)
    source = "".join(char for char, _ in pairs) + "".join(gone)
    return source, "".join(folded for _, folded in pairs), tuple(several)


def _ranges(chars: Iterable[str], gap: int = 64) -> str:
    """A few ranges covering the characters; what else they cover takes the long way for nothing."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in ranges)


def _hangul_parts(c: Column) -> Column:
    """Each Hangul syllable as its two or three letters, other characters unchanged."""
    leads, vowels, tails = (
        F.array(*[F.lit(part) for part in parts]) for parts in (_LEADS, _VOWELS, _TAILS)
    )

    def decompose(char: Column) -> Column:
        index = F.ascii(char) - F.lit(_HANGUL_FIRST)
        return F.when(
            (index >= 0) & (index <= _HANGUL_LAST - _HANGUL_FIRST),
            F.concat(
                F.get(leads, F.floor(index / 588).cast("int")),
                F.get(vowels, F.floor((index % 588) / 28).cast("int")),
                F.get(tails, (index % 28).cast("int")),
            ),
        ).otherwise(char)

    return F.array_join(F.transform(F.split(c, ""), decompose), "")


def fold_accents(c: Column, probe: Column | None = None) -> Column:
    """Decompose and drop non-spacing marks.

    ``probe`` is a column holding at least the characters of ``c``, by default ``c`` itself. It
    picks the cheapest sufficient branch per row: ASCII text is returned as it is, most other
    text takes one ``translate`` and only rows with the rare characters take the long way.
    """
    probe = c if probe is None else probe
    source, target, several = _fold_tables()
    rare = "[" + _ranges(char for char, _ in several) + "가-힣]"
    folded = F.translate(c, source, target)
    expanded = c
    for char, parts in several:
        expanded = F.replace(expanded, F.lit(char), F.lit(parts))
    expanded = F.translate(_hangul_parts(expanded), source, target)
    return (
        F.when(F.octet_length(probe) == F.length(probe), c)
        .when(~probe.rlike(rare), folded)
        .otherwise(expanded)
    )


def strip_special(c: Column) -> Column:
    """Everything but words, white space and basic punctuation becomes a space."""
    return _replace(c, NOT_KEPT)


def squeeze_repeats(c: Column) -> Column:
    """Three or more of one character become two; line feeds are left alone."""
    return _replace(c, r"([^\n])\1{2,}+", "$1$1")


def squeeze_punct(c: Column) -> Column:
    """Runs of full stops, of exclamation marks and of question marks become one each."""
    for mark in ".!?":
        c = _replace(c, f"[{mark}]{{2,}}", mark)
    return c


def squeeze_space(c: Column) -> Column:
    """White space runs become one space; none at either end."""
    return F.trim(_replace(c, LOOSE_SPACE))


def lower(c: Column) -> Column:
    """Lower case."""
    return F.lower(c)


def clean_text(c: Column) -> Column:
    """The whole cleaning chain; text with nothing left becomes null.

    The steps before only remove characters, so what the text itself lacks they lack too.
    """
    text = strip_urls(strip_html(c))
    marked = F.contains(c, F.lit("@")) | F.contains(c, F.lit("#"))
    text = F.when(marked, strip_social(strip_phones(strip_emails(text)))).otherwise(strip_phones(text))
    text = strip_special(fold_accents(text, probe=c))
    text = lower(squeeze_space(squeeze_punct(squeeze_repeats(text))))
    return F.nullif(text, F.lit(""))


def clean_again(c: Column) -> Column:
    """The second cleaning pass: link words, words with "@" and long numbers go; null is ''."""
    text = _replace(F.coalesce(c, F.lit("")), LINK_WORD, "")
    text = F.when(F.contains(c, F.lit("@")), _replace(text, AT_WORD, "")).otherwise(text)
    return squeeze_space(_replace(text, LONG_NUMBER, ""))


def text_length(c: Column) -> Column:
    """Length in code points."""
    return F.length(c)


def word_count(c: Column) -> Column:
    """Number of words between white space; 0 for empty text.

    Every word is reduced to its first character and what is left is counted.
    """
    first = rf"{UNICODE}[{SPACE}]*+([^{SPACE}]?)[^{SPACE}]*+"
    return F.length(_replace(c, first, "$1"))


def words(c: Column) -> Column:
    """The words between white space, in order; empty for empty text."""
    return F.array_remove(F.split(c, rf"{UNICODE}[{SPACE}]+"), "")


def full_review(title: Column, text: Column) -> Column:
    """Title, space, text; a null part counts as ''."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))


def is_blank(c: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(~c.rlike(rf"{UNICODE}[^{SPACE}]"), F.lit(True))
