"""Regular expressions and column functions for note text.

The patterns below are fixed values: they define which part of a report is
kept, and must stay exactly as they are for results to agree.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
# Report separator: three or more hyphens.
SEPARATOR_PATTERN = "-{3,}"
# Trailing boilerplate removed from every report, case-insensitive, to the end
# of the text:  "(Findings|Results)\s+were\s+communicated.*"  and
# "electronically signed.*".
# Token pattern for TF-IDF and vocabulary encoding: runs of two or more word
# characters (letters, digits, underscore).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Every character Python's str.isspace() accepts.  Java's own \s (even with
# UNICODE_CHARACTER_CLASS) and RE2's \s both differ from it (NBSP, \x1c-\x1f,
# vertical tab), so whitespace is spelled out once and used by both engines.
WS = (r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

COMMUNICATED = rf"(?isu)(Findings|Results){WS}+were{WS}+communicated.*"
SIGNED = r"(?isu)electronically signed.*"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# WS as the characters themselves, for ``trim``
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# A run of WS that is not one space already.  Visible ASCII characters are told
# apart by the first test of a class, before the long list of WS.
_NOT_ONE_SPACE = rf"[[^ -~]&&{WS}]{WS}*+| {WS}++"
# Characters outside ASCII that match an ASCII letter when case is ignored.
_FOLDED = "\u0130\u0131\u017f\u212a"


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace (Python semantics; ``trim`` alone
    only removes spaces)."""
    return F.trim(_col(c), F.lit(WS_CHARS))


def clean_report_text(c) -> Column:
    """Drop the communicated/signature tail, collapse whitespace, trim (C6);
    may return the empty string.

    Both tails go to the end of the text and cannot overlap, so one pass cuts
    at the first; it runs only where a fixed word of a tail is there (or a
    letter that stands for an ASCII one when case is ignored)."""
    c = _col(c)
    may = F.contains(F.lower(c), F.lit("communicated")) | F.contains(F.lower(c), F.lit("electronically signed"))
    for letter in _FOLDED:
        may = may | F.contains(c, F.lit(letter))
    t = F.when(may, F.regexp_replace(c, f"(?:{COMMUNICATED})|(?:{SIGNED})", "")).otherwise(c)
    return strip_ws(F.regexp_replace(t, _NOT_ONE_SPACE, " "))


def clean_report(c) -> Column:
    """:func:`clean_report_text` with an empty result as NULL.  Inside a
    larger projection prefer computing :func:`clean_report_text` into a
    column and testing its length, so the regex chain runs once."""
    t = clean_report_text(c)
    return F.when(F.length(t) > 0, t)


def tokens(c) -> Column:
    """Lower-cased tokens of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"({TOKEN_PATTERN})"), 1)
