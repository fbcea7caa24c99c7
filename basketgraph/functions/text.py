"""Feedback text cleaning as column expressions.

The chain is: keep ASCII letters and whitespace, trim, lower-case, delete stop
words (whole words, looked up as a set), split on single spaces. Everything runs in
the JVM (``regexp_replace``, ``split``, higher-order ``filter``); no Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s class spelled out, so the same pattern means the same in other regex dialects.
WHITESPACE = r" \t\n\x0B\f\r"
# One match per run of unwanted characters, not one per character.
NON_LETTER = rf"[^a-zA-Z{WHITESPACE}]+"
# The same six characters, literally, for a native two-sided trim.
WHITESPACE_CHARS = " \t\n\x0b\f\r"
_META = set(".^$*+?()[]{}|\\-/")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def escape_word(word: str) -> str:
    """Backslash-escape regex metacharacters so a word matches only itself."""
    return "".join("\\" + ch if ch in _META else ch for ch in word)


def words_pattern(words: Iterable[str], literal: bool = True) -> str:
    """``\\b(?:w1|w2|...)\\b``. With ``literal=False`` words act as patterns (``co.`` also hits ``cop``)."""
    alts = [escape_word(w) if literal else w for w in words if w]
    if not alts:
        return ""
    return r"\b(?:" + "|".join(alts) + r")\b"


def keep_letters(col: Column | str) -> Column:
    """Drop everything but ASCII letters and whitespace; accented letters vanish."""
    return F.regexp_replace(_c(col), NON_LETTER, "")


def trim_whitespace(col: Column | str) -> Column:
    """Trim tabs and line breaks too, not only spaces (plain ``trim`` removes spaces only).

    After ``keep_letters`` these six characters are the only non-letters left, so
    this equals a trim of every control character and space.
    """
    return F.trim(_c(col), F.lit(WHITESPACE_CHARS))


def remove_words(col: Column | str, words: Iterable[str], literal: bool = True) -> Column:
    """Delete whole-word occurrences of ``words``; the surrounding spaces stay."""
    pattern = words_pattern(words, literal)
    return _c(col) if not pattern else F.regexp_replace(_c(col), pattern, "")


def remove_word_set(col: Column | str, words: Iterable[str]) -> Column:
    """``remove_words`` for words of ASCII letters on a text of ASCII letters and white space.

    One scan cuts the text into runs of letters and runs of white space, and a hash set (``INSET``) drops the runs that
    are words, so the time does not grow with their number as it does with one long alternation.
    """
    words = list(dict.fromkeys(words))
    if not words:
        return _c(col)
    runs = F.regexp_extract_all(_c(col), F.lit(f"[a-zA-Z]+|[{WHITESPACE}]+"), F.lit(0))
    return F.array_join(F.filter(runs, lambda run: ~run.isin(words)), "")


def clean_text(col: Column | str, stop_words: Iterable[str], literal: bool = True) -> Column:
    """Letters only, trimmed, lower case, stop words removed.

    After cleaning, literal stop words can only match as whole runs of lower-case letters, so they are looked up as a set;
    others never match and are left out. Patterns and stop phrases with white space take the regular expression.
    """
    text, stop_words = F.lower(trim_whitespace(keep_letters(col))), [w for w in stop_words if w]
    if not literal or any(ch in w for w in stop_words for ch in WHITESPACE_CHARS):
        return remove_words(text, stop_words, literal)
    return remove_word_set(text, [w for w in stop_words if re.fullmatch("[a-z]+", w)])


def tokens(col: Column | str) -> Column:
    """Split on single spaces and drop empty tokens (tabs and newlines do not split)."""
    return F.filter(F.split(_c(col), " "), lambda t: t != "")


def normalize_words(words: Iterable[str]) -> list[str]:
    """Apply the text cleaning rule to a word list itself (letters only, trimmed, lower case).

    Lexicon entries such as ``all-around`` can never equal a cleaned token; their
    cleaned form ``allaround`` can. Runs on the driver over the word list only.
    Entries that clean to nothing are dropped; order and first occurrence are kept.
    """
    out = []
    for w in words:
        c = re.sub(NON_LETTER, "", w).strip(WHITESPACE_CHARS).lower()
        if c:
            out.append(c)
    return list(dict.fromkeys(out))


def count_in(tokens_col: Column, words: Iterable[str]) -> Column:
    """Number of tokens found in ``words``.

    The membership test is an ``IN`` list, which the optimizer turns into a hash
    set lookup (``INSET``) for lists above a handful of entries.
    """
    words = list(dict.fromkeys(w for w in words if w))
    if not words:
        return F.lit(0)
    return F.size(F.filter(tokens_col, lambda t: t.isin(words)))
