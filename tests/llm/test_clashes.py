"""Input columns whose names differ from added ones in their case only."""

from __future__ import annotations

import pytest

from arborload.llm import counting, lines, mixing, pieces, quality, toxicity
from arborload.llm.queries import tokenizer_path
from conftest_llm import LABELS


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1)], LABELS)


OPERATORS = {
    "quality": (lambda s, d: quality.scored(d, labels(s)), "Kept"),
    "lines": (lambda s, d: lines.drop_recurring(d), "N_Lines"),
    "mixing": (lambda s, d: mixing.replicate(d), "RATE"),
    "counting": (lambda s, d: counting.counted(d, tokenizer_path()), "N_TOKENS"),
    "toxicity": (lambda s, d: toxicity.scored(d, toxicity.fit(d, labels(s))), "Score"),
    "pieces": (lambda s, d: pieces.encoded(d, tokenizer_path("piece_bpe_32k.model")), "Ids"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_column_is_replaced_whatever_its_case(spark, make, name):
    operator, column = OPERATORS[name]
    docs = make([(i, f"some text number {i} that goes on", "s") for i in range(4)]).withColumnRenamed("n_chars", column)
    found = operator(spark, docs)
    names = [c.lower() for c in found.columns]
    assert names.count(column.lower()) == 1
    assert found.select(column.lower()).count() == found.count()
