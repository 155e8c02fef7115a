"""Document-number recognition as native column expressions.

A document number is two digits, one capital letter and six digits
(``00C074511``).  Call notes name them in free text, sometimes in short form:
``00C074511-23`` means ``00C074511`` and ``00C074523``.

The recogniser is a scan over the tokens of a text, written with
``aggregate`` so it stays inside the JVM (no Python worker; the higher-order
functions are evaluated by the JVM row by row, the scan and filters around
them are whole-stage codegen).  Digits are ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# The shape of a full document number, and of a short completion.
FULL_PATTERN = "[0-9]{2}[A-Z][0-9]{6}"
FULL_LENGTH = 9
SHORT_MAX_DIGITS = 6
# Token separator: any run of non-word characters.
TOKEN_SPLIT = "\\W+"
# Characters stripped from both ends of a text (Python's str.strip set).
STRIP_CHARS = " \t\n\r\x0b\x0c"
# --- end of fixed values ------------------------------------------------------
BLOCK = 128  # tokens folded into one list at a time


def clean_text(col: Column) -> Column:
    """Strip surrounding whitespace and upper-case."""
    return F.upper(F.trim(col, F.lit(STRIP_CHARS)))


def tokens(text: Column) -> Column:
    """split on runs of non-word characters (empty edge tokens kept)."""
    return F.split(text, TOKEN_SPLIT)


def has_full_number(text: Column) -> Column:
    """The text contains a full number anywhere."""
    return text.rlike(FULL_PATTERN)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _then(before: Column, token: Column) -> Column:
    """``before`` with its end replaced by ``token``, or ``token`` when that is
    at least as long.  The operation is associative, and a full number
    forgets everything before it."""
    kept = F.greatest(F.length(before) - F.length(token), F.lit(0))
    return F.concat(F.substring(before, F.lit(1), kept), token)


def parse_tokens(toks: Column, complete_short: bool) -> Column:
    """The document numbers of a token list, left to right.

    1. A token containing a full number is taken (its first full number)
       when the token is exactly that long, or its next character is not a
       digit (``03C5263414`` is rejected, ``03C526333A`` gives ``03C526333``).
    2. With ``complete_short``: a token of 1-6 ASCII digits completes the
       number found last: ``last[:9 - len(token)] + token``.
    3. Anything else is ignored.

    The numbers are the running values of ``_then``: being associative, it is
    folded over blocks of ``BLOCK`` tokens, over the blocks' values, and then
    inside each block from the value before it, so no list longer than a block
    (or than the number of blocks) is copied while it grows.  Values before the
    first full number are shorter than one and dropped.
    """
    def full_of(t):
        return F.regexp_extract(t, FULL_PATTERN, 0)

    def accepts_full(t):
        return (full_of(t) != F.lit("")) & (
            (F.length(t) == FULL_LENGTH)
            | ~F.substring(t, FULL_LENGTH + 1, 1).rlike("^[0-9]$"))

    if not complete_short:
        return F.transform(F.filter(toks, accepts_full), full_of)

    def is_short(t):
        return t.rlike(f"^[0-9]{{1,{SHORT_MAX_DIGITS}}}$")

    # "" where a token has no say
    said = F.transform(toks, lambda t: F.when(accepts_full(t), full_of(t)).when(is_short(t), t).otherwise(""))
    candidates = F.filter(said, lambda t: t != "")

    def running(tokens_, start):
        """``start`` and the value after each token."""
        return F.aggregate(tokens_, F.array(start), lambda acc, t: F.concat(acc, F.array(_then(F.element_at(acc, -1), t))))

    def blocks_of(c):
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(c) / BLOCK).cast("int")),
                           lambda i: F.slice(c, i * BLOCK + 1, BLOCK))

    def numbers(blocks):
        values = F.transform(blocks, lambda b: F.aggregate(b, F.lit(""), _then))
        starts = F.slice(running(values, F.lit("")), F.lit(1), F.size(blocks))
        inside = F.zip_with(blocks, starts, lambda b, s: F.slice(running(b, s), F.lit(2), F.size(b)))
        return F.filter(F.flatten(inside), lambda v: F.length(v) == FULL_LENGTH)

    return F.when(toks.isNotNull(), _bind(_bind(candidates, blocks_of), numbers))


def legacy_matches(text: Column) -> Column:
    """Every full number or word-initial digit run, in order."""
    return F.regexp_extract_all(text, F.lit(f"({FULL_PATTERN}|\\b[0-9]+)"), 1)


def complete_from_first(matches: Column) -> Column:
    """Short runs (<= 6 digits) are completed from the row's first match;
    longer runs are kept as they are."""
    first = F.element_at(matches, 1)
    return F.transform(
        matches,
        lambda m: F.when(F.length(m) <= SHORT_MAX_DIGITS,
                         F.concat(F.substring(first, 1, FULL_LENGTH - F.length(m)), m))
                  .otherwise(m))
