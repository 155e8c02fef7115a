import json
import random

import pytest

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "river", "stone", "cloud", "amber", "quiet", "lantern", "meadow", "harbour", "winter"])
                    + rng.choice(["", "s", "ly", "er", "ing", "eth", "ion"]) for _ in range(n))


@pytest.fixture()
def rng():
    return random.Random(11)


@pytest.fixture()
def docs_of(spark):
    """Documents from (id, text) pairs, with columns of clashing names."""
    def make(rows):
        full = [(i, t, "en", "src", 0, "w", 1, "x", "y") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n_chars bigint, _w string, fp int, text_hash string, n_words string")

    return make


def as_json(rows):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in rows)
