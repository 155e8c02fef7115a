import random

import pytest

from callcredit.operators import revenue, revenue_delta

LINE = "RootDocumentNumber string, PartSales double, OpenDate string, ContractStart string, ContractEnd string"
MENTION = "MeetingId bigint, RootDocumentNumber string"
DATES = [None, "2015-01-01", "2016-06-01", "2018-01-01"]


def _line(rng, docs):
    return (rng.choice(docs), rng.choice([0.0, 5.0, -5.0, 2.5, None]), rng.choice(DATES), rng.choice(DATES), rng.choice(DATES))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_a_full_build(spark, seed):
    """Two batches that add, drop and change lines and mentions."""
    rng = random.Random(seed)
    docs = [f"6{i}C{i:06d}" for i in range(9)] + [None]
    lines = [_line(rng, docs) for _ in range(25)]
    mentions = [(rng.choice([1, 2, 3, 4, 5, 6, None]), rng.choice(docs)) for _ in range(18)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    documents = revenue_delta.document_table(frame(mentions, MENTION), frame(lines, LINE))
    calls = revenue_delta.credit_calls(frame(mentions, MENTION), documents)
    assert _rows(calls) == _rows(revenue.attribute_revenue(frame(mentions, MENTION), frame(lines, LINE)))
    for _ in range(2):
        gone_l, gone_m = rng.sample(lines, 6), rng.sample(mentions, 4)
        new_l = [_line(rng, docs) for _ in range(5)]
        new_m = [(rng.randint(1, 9), rng.choice(docs)) for _ in range(4)]
        for x in gone_l:
            lines.remove(x)
        for x in gone_m:
            mentions.remove(x)
        lines, mentions = lines + new_l, mentions + new_m
        changes = revenue_delta.Changes(frame(new_l, LINE), frame(gone_l, LINE), frame(new_m, MENTION), frame(gone_m, MENTION))
        documents, touched = revenue_delta.update_documents(documents, frame(lines, LINE), changes)
        calls = revenue_delta.update_calls(calls, documents, frame(mentions, MENTION), touched, changes)
        assert _rows(calls) == _rows(revenue.attribute_revenue(frame(mentions, MENTION), frame(lines, LINE)))
        full = revenue_delta.document_table(frame(mentions, MENTION), frame(lines, LINE))
        assert _rows(documents.select(*full.columns)) == _rows(full)


def test_no_changes_and_empty_state(spark):
    none_l, none_m = spark.createDataFrame([], LINE), spark.createDataFrame([], MENTION)
    changes = revenue_delta.Changes(none_l, none_l, none_m, none_m)
    documents = revenue_delta.document_table(none_m, none_l)
    now, touched = revenue_delta.update_documents(documents, none_l, changes)
    calls = revenue_delta.update_calls(revenue_delta.credit_calls(none_m, documents), now, none_m, touched, changes)
    assert now.count() == touched.count() == calls.count() == 0
