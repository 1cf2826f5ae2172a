import random

import pytest
from pyspark.sql import functions as F

from handbill.operators import messages
from handbill.operators.digest import pack_lines


def both(spark, lines, limit, block_chars):
    rows = [(number * 3 - 5, line) for number, line in enumerate(lines)]
    random.Random(1).shuffle(rows)
    got = messages.pack_digest(spark.createDataFrame(rows, "line_no INT, line STRING"), limit, block_chars).collect()
    text = spark.createDataFrame([("\n".join(lines),)], "text STRING")
    want = text.select(pack_lines(F.col("text"), limit).alias("chunks")).first().chunks
    assert [r.text for r in sorted(got, key=lambda r: r.message_no)] == want
    assert sorted(r.message_no for r in got) == list(range(len(want)))
    return got


@pytest.mark.parametrize("block_chars", [0, 100, 10_000_000])
def test_a_digest_packs_as_its_joined_text(spark, monkeypatch, block_chars):
    monkeypatch.setattr(messages, "LINES_PER_RANGE", 16)
    of = random.Random(7)
    lines = ["ż" * of.choice([0, 0, 1, 5, 12, 29, 30, 31, 59, 60, 61, 250]) + of.choice(["", " ", "a"]) for _ in range(250)]
    got = both(spark, lines, 60, block_chars)
    assert sum(r.n_lines for r in got) >= 240


def test_ends_and_small_digests(spark):
    both(spark, ["a", "b", "", " ", ""], 4, 0)
    both(spark, ["x" * 500], 10, 0)
    both(spark, ["", "", ""], 2, 0)
    both(spark, ["x" * 500, "", "", "y" * 300, "z"], 10, 0)
    empty = spark.createDataFrame([], "line_no INT, line STRING")
    assert messages.pack_digest(empty, 10).collect() == []
