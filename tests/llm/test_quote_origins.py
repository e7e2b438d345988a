"""Origins in other conversations when the asking one comes first."""

from __future__ import annotations

import pytest

from fxtape.llm import quotes


@pytest.mark.parametrize("own,other", [(1, 2), (2, 1)])
def test_passage_of_the_second_conversation(spark, own, other):
    rows = [(own, 2, "> P"), (own, 3, "P"), (other, 0, "P"), (7, 1, "P"), (8, 0, "> P")]
    passages, _ = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    links = {(r.conv, r.turn): (r.from_conv, r.from_turn) for r in passages.collect()}
    assert links == {(own, 2): (other, 0), (8, 0): (1, 3) if own == 1 else (1, 0)}


def test_own_conversation_alone_is_no_origin(spark):
    rows = [(1, 2, "> P"), (1, 3, "P")]
    passages, _ = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert [(r.from_conv, r.from_turn) for r in passages.collect()] == [(None, None)]
