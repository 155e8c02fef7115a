import random
import re

import pytest
from pyspark.sql import functions as F

from callcredit.functions import docnum as dn
from callcredit.operators import docnum

FULL, NEXT = "83K150042", "19W733906"
# One row per rule: what the field holds, what the notes hold, and the numbers
# that the field and the notes give.
RULES = {
    "a number by itself": (FULL, FULL, [FULL], [FULL]),
    "a letter behind it": (FULL + "Q7", FULL + "Q7", [FULL], [FULL]),
    "a digit behind it": (FULL + "5", FULL + "5", [], []),
    "an underscore does not split": (FULL + "_" + NEXT, "_" + FULL, [FULL], []),
    "separators split": (f"{FULL}/{NEXT}", f"({FULL}) <i>{NEXT}</i>;", [FULL, NEXT], [FULL, NEXT]),
    "short digits complete the number before, in the field only": (f"{FULL} 7", f"{FULL} 7", [FULL, FULL[:8] + "7"], [FULL]),
    "six digits complete, seven do not": (f"{FULL},654321,7654321", "", [FULL, FULL[:3] + "654321"], []),
    "a completed number is completed again": (f"{FULL}+61+9", "", [FULL, FULL[:7] + "61", FULL[:7] + "69"], []),
    "the last full number counts": (f"{FULL} {NEXT} 88", "", [FULL, NEXT, NEXT[:7] + "88"], []),
    "short digits before any number": (f"4 {FULL}", "", [FULL], []),
    "no number at all": ("to follow", "4 tyres, none in stock", [], []),
    "empty and missing": ("", None, [], []),
    "lower case": (FULL.lower(), NEXT.lower(), [FULL], [NEXT]),
}
ROWS = [(i, field, notes) for i, (field, notes, _, _) in enumerate(RULES.values(), 1)]
SCHEMA = "MeetingId bigint, PartsDocumentNumber string, Notes string"


def _collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.MeetingId, []).append(r.RootDocumentNumber)
    return out


@pytest.fixture()
def calls(spark):
    return docnum.upper_text_columns(spark.createDataFrame(ROWS, SCHEMA))


def test_upper_keeps_key_type(spark, calls):
    assert dict(calls.dtypes)["MeetingId"] == "bigint"
    assert calls.where(F.col("MeetingId") == 11).first().PartsDocumentNumber == "TO FOLLOW"


def test_field_rules(calls):
    got = _collect(docnum.extract_from_field(calls))
    for i, (name, (_, _, want, _)) in enumerate(RULES.items(), 1):
        assert got.get(i, []) == want, name


def test_notes_rules(calls):
    got = _collect(docnum.extract_from_notes(calls))
    for i, (name, (_, _, _, want)) in enumerate(RULES.items(), 1):
        assert got.get(i, []) == want, name


EXTRA = [
    (1, "83K150042-23-4", None, ["83K150042", "83K150023", "83K150024"]),
    (2, "83K150042 1234567", None, ["83K150042"]),
    (3, "12 83K150042", None, ["83K150042"]),
    (4, "83K150042_X", None, ["83K150042"]),
    (5, None, None, []),
    (6, "83k150042-7", None, ["83K150042", "83K150047"]),
]


def test_field_edge_cases(spark):
    df = docnum.upper_text_columns(spark.createDataFrame([r[:3] for r in EXTRA], SCHEMA))
    got = _collect(docnum.extract_from_field(df))
    for mid, _, _, want in EXTRA:
        assert got.get(mid, []) == want, mid


def test_number_in_both_columns(spark):
    df = spark.createDataFrame([(9, "83K150042", "see 83K150042")], SCHEMA)
    assert docnum.extract_all(df, distinct=False).count() == 2
    assert docnum.extract_all(df, distinct=True).count() == 1


def _model(tokens, complete_short):
    """Plain Python statement of the published token rule (ASCII digits)."""
    res = []
    for t in tokens:
        m = re.search(r"[0-9]{2}[A-Z][0-9]{6}", t)
        if m and (len(t) == 9 or (len(t) > 9 and not ("0" <= t[9] <= "9"))):
            res.append(m.group(0))
        elif complete_short and len(t) <= 6 and re.fullmatch(r"[0-9]+", t) and res:
            res.append(res[-1][: len(res[-1]) - len(t)] + t)
    return res


def test_fold_matches_model(spark):
    rng = random.Random(7)
    alphabet = ["83K150042", "12", "1234567", "3", "AB", "19W7339064", "19W733901A", "", "45S000001",
                "999999", "0", "X1"]
    rows = [(i, [rng.choice(alphabet) for _ in range(rng.randint(0, 8))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, toks array<string>")
    for short in (True, False):
        got = {r.id: r.out for r in df.select("id", dn.parse_tokens(F.col("toks"), short).alias("out")).collect()}
        for i, toks in rows:
            assert got[i] == _model(toks, short), (toks, short)


def test_long_lists_match_model(spark):
    """Lists around and far beyond the block length, a full number now and then."""
    rng = random.Random(5)
    rows = []
    for i, n in enumerate([dn.BLOCK - 1, dn.BLOCK, dn.BLOCK + 1, 3 * dn.BLOCK, 20_000]):
        some = [str(rng.randrange(10 ** rng.randint(1, 6))) if rng.random() < 0.99 else f"{rng.randrange(10, 99)}K{rng.randrange(10 ** 5, 10 ** 6)}"
                for _ in range(n)]
        rows.append((i, some))
    df = spark.createDataFrame(rows, "id int, toks array<string>")
    got = {r.id: r.out for r in df.select("id", dn.parse_tokens(F.col("toks"), True).alias("out")).collect()}
    for i, toks in rows:
        assert got[i] == _model(toks, True), i


def test_legacy_first_base(spark):
    df = spark.createDataFrame([(1, "83K150042-23 1234567", "x 19W7339064"),
                                (2, "see 83K150042", None)], SCHEMA)
    got = sorted((r.MeetingId, r.RootDocumentNumber) for r in docnum.extract_legacy(df).collect())
    # anchored mask: row 2's field does not start with a number; notes take
    # any full number (no next-character check)
    assert got == sorted([(1, "83K150042"), (1, "83K150023"), (1, "1234567"), (1, "19W733906")])


def test_extractors_match_model_on_random_texts(spark):
    """The whole extraction (upper, strip, split, fold, explode) against the model
    on random texts built from number-like fragments and separators."""
    rng = random.Random(11)
    frags = ["83K150042", "27m004410", "23", "4", "1234567", "19W7339064", "12A345678B", "x", "doc",
             "99Z999999", "000001", "_", "-", "/", "&", " ", ", ", "\t", "<p>"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(frags) for _ in range(rng.randint(0, 10)))
        rows.append((i, text if rng.random() > 0.05 else None, text[::-1] if rng.random() > 0.05 else None))
    df = spark.createDataFrame(rows, SCHEMA)

    def model(text, short):
        if text is None:
            return []
        up = text.upper()
        if not re.search(r"[0-9]{2}[A-Z][0-9]{6}", up):
            return []
        return [x for x in _model(re.split(r"[^A-Za-z0-9_]+", up.strip(" \t\n\r\x0b\x0c")), short) if x]

    field = _collect(docnum.extract_from_field(docnum.upper_text_columns(df)))
    notes = _collect(docnum.extract_from_notes(docnum.upper_text_columns(df)))
    for i, f, n in rows:
        assert field.get(i, []) == model(f, True), f
        assert notes.get(i, []) == model(n, False), n


def test_legacy_positions(spark):
    df = spark.createDataFrame([(1, "83K150042-23", "a 19W733906 b 19W733907")], SCHEMA)
    got = sorted((r.source, r.match, r.RootDocumentNumber)
                 for r in docnum.extract_legacy(df, with_position=True).collect())
    assert got == [("Notes", 0, "19W733906"), ("Notes", 1, "19W733907"),
                   ("PartsDocumentNumber", 0, "83K150042"), ("PartsDocumentNumber", 1, "83K150023")]


def test_legacy_matches_pandas_statement(spark):
    """The earlier parser as pandas code (anchored mask, extractall of full
    numbers or word-initial digit runs, short runs completed from the row's
    first match, notes' full numbers, (call, number) duplicates dropped)."""
    import pandas as pd
    rng = random.Random(17)
    frags = ["83K150042", "-23", " 4", " 1234567", "X", " ", "/", "&", "19W7339064", "12", "ab 45S000001"]
    rows = []
    for i in range(300):
        f = "".join(rng.choice(frags) for _ in range(rng.randint(0, 6)))
        n = "".join(rng.choice(frags) for _ in range(rng.randint(0, 6)))
        rows.append((i, f if rng.random() > 0.05 else None, n if rng.random() > 0.05 else None))
    got = sorted((r.MeetingId, r.RootDocumentNumber)
                 for r in docnum.extract_legacy(spark.createDataFrame(rows, SCHEMA)).collect())

    pat = r"\d{2}[A-Z]\d{6}"
    pdf = pd.DataFrame(rows, columns=["MeetingId", "PartsDocumentNumber", "Notes"]).set_index("MeetingId")
    for c in ("PartsDocumentNumber", "Notes"):
        pdf[c] = pdf[c].str.strip().str.upper()
    mask = pdf["PartsDocumentNumber"].str.match(pat).fillna(False).astype(bool)
    found = []
    for mid, text in pdf.loc[mask, "PartsDocumentNumber"].items():
        ms = re.findall(rf"({pat}|\b\d+)", text)
        first = ms[0]
        found += [(mid, first[: 9 - len(m)] + m if len(m) <= 6 else m) for m in ms]
    for mid, text in pdf["Notes"].dropna().items():
        found += [(mid, m) for m in re.findall(rf"({pat})", text)]
    assert got == sorted(set(found))
