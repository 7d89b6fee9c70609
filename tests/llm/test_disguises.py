"""Disguises whose signs run to an end of the word, or that double one letter."""

import pytest

from tests.llm.test_models import corpus
from wardline.llm import toxicity


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(*corpus(spark))


def test_signs_at_the_ends_and_one_doubled_letter(spark, model):
    for span, want in {"tr4$#": "trash", "+rash": "trash", "(at": "cat", "cat!": "cat", "stuupid": "stupid", "m0ron!": "moron"}.items():
        assert toxicity.decode(span.encode(), model.cost).decode().strip() == want
    bad = ["the tr4$# sat", "the +rash sat", "a stuupid cat", "a lo5er!", "old mor0n", "tra$#"]
    fine = ["(the cat) sat!", "a *mat* #1", "the old dog + cat", "wall !", "a house 107", "saw the dog|cat"]
    rows = spark.createDataFrame(list(enumerate(bad + fine)), "doc_id long, text string")
    out, c = toxicity.score(rows, model)
    got = {r["text"]: r[c] for r in out.collect()}
    assert [t for t in bad if got[t] < 0.3] == [] and [t for t in fine if got[t] >= 0.3] == []
