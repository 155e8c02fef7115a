"""Document numbers named by calls.

Input: calls with ``MeetingId`` and the two free-text columns
``PartsDocumentNumber`` (the document field) and ``Notes``.  Output: one row
per number found, ``MeetingId, RootDocumentNumber`` (plus ``match`` for the
legacy form).  Everything is a narrow per-row plan: filter, project, fold,
explode.  No shuffle except the optional ``distinct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import docnum as dn

DOC = "RootDocumentNumber"
FIELD = "PartsDocumentNumber"
NOTES = "Notes"


def upper_text_columns(df: DataFrame, columns=(FIELD, NOTES)) -> DataFrame:
    """F6 / D-7: upper-case the text columns only; keys keep their type."""
    present = {c.lower() for c in df.columns}
    return df.withColumns({c: F.upper(F.col(c)) for c in columns if c.lower() in present})


def _extract(df: DataFrame, text_col: str, complete_short: bool, id_col: str) -> DataFrame:
    text = dn.clean_text(F.col(text_col))
    found = dn.parse_tokens(dn.tokens(text), complete_short)
    return (df.where(dn.has_full_number(F.upper(F.col(text_col))))
            .select(F.col(id_col).alias("MeetingId"), F.explode(found).alias(DOC))
            .where(F.length(DOC) != 0))


def extract_from_field(calls: DataFrame, id_col: str = "MeetingId") -> DataFrame:
    """Full numbers of the document field, short ones completed."""
    return _extract(calls, FIELD, True, id_col)


def extract_from_notes(calls: DataFrame, id_col: str = "MeetingId") -> DataFrame:
    """Full numbers of the notes only."""
    return _extract(calls, NOTES, False, id_col)


def _numbers(text_col: str, complete_short: bool):
    """The numbers of one text column as an array; the fold only runs on
    texts that contain a full number (the others give none anyway)."""
    text = dn.clean_text(F.col(text_col))
    return (F.when(dn.has_full_number(F.upper(F.col(text_col))),
                   dn.parse_tokens(dn.tokens(text), complete_short))
            .otherwise(F.array().cast("array<string>")))


def extract_all(calls: DataFrame, distinct: bool = True, id_col: str = "MeetingId") -> DataFrame:
    """Field numbers and notes numbers together.

    One pass over the calls: both columns are folded in the same projection
    and exploded together (the same rows as the union of the two
    extractors, with one scan of the texts instead of two).
    ``distinct=True`` (default) keeps one row per (call, number); ``False``
    keeps a number found in both columns twice, as the published job does.
    """
    both = (calls.select(F.col(id_col).alias("MeetingId"),
                         F.explode(F.concat(_numbers(FIELD, True), _numbers(NOTES, False))).alias(DOC))
            .where(F.length(DOC) != 0))
    return both.distinct() if distinct else both


def extract_legacy(calls: DataFrame, id_col: str = "MeetingId", with_position: bool = False) -> DataFrame:
    """The earlier parser.

    The document field must *start* with a full number (after strip and
    upper-case); every full number or word-initial digit run is taken, runs
    of up to six digits are completed from the row's *first* number.  Notes
    give every full number anywhere (no next-character check).  The two sets
    are combined with duplicates of (call, number) removed (J10 + F17: an
    outer join of the two match lists on (call, match) unpivoted to one
    column is the same multiset as concatenating them; U3 drops repeats).

    ``with_position=True`` returns every match before de-duplication with
    its position inside its text (``match``, W5) and the column it came
    from (``source``).
    """
    field = dn.clean_text(F.col(FIELD))
    notes = dn.clean_text(F.col(NOTES))
    field_ok = F.coalesce(field.rlike("^" + dn.FULL_PATTERN), F.lit(False))
    if not with_position:
        # one pass over the calls: both columns' matches exploded together
        empty = F.array().cast("array<string>")
        field_numbers = F.when(field_ok, dn.complete_from_first(dn.legacy_matches(field))).otherwise(empty)
        notes_numbers = F.coalesce(F.regexp_extract_all(notes, F.lit(f"({dn.FULL_PATTERN})"), 1), empty)
        return (calls.select(F.col(id_col).alias("MeetingId"),
                             F.explode(F.concat(field_numbers, notes_numbers)).alias(DOC))
                .where(F.col(DOC).isNotNull())
                .distinct())
    from_field = (calls.where(field_ok)
                  .select(F.col(id_col).alias("MeetingId"),
                          F.posexplode(dn.complete_from_first(dn.legacy_matches(field)))
                          .alias("match", DOC)))
    from_notes = (calls.where(F.col(NOTES).isNotNull())
                  .select(F.col(id_col).alias("MeetingId"),
                          F.posexplode(F.regexp_extract_all(notes, F.lit(f"({dn.FULL_PATTERN})"), 1))
                          .alias("match", DOC)))
    return (from_field.withColumn("source", F.lit(FIELD))
            .unionByName(from_notes.withColumn("source", F.lit(NOTES))))
