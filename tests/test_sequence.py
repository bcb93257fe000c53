"""The windows against the literal patterns, on every short label string."""

import itertools
import re

import pytest
from palaver.operators import sequence

#: The patterns that the windows stand for.
SEGMENT = re.compile("((1)((22)*2))+")


def by_pattern(labels):
    text, out = "".join(map(str, labels)), [None] * len(labels)
    for i, m in enumerate(SEGMENT.finditer(text)):
        out[m.start() : m.end()] = [i] * (m.end() - m.start())
    return out


@pytest.fixture(scope="module")
def strings():
    return [s for n in range(1, 8) for s in itertools.product((0, 1, 2), repeat=n)]


def rows(spark, strings):
    flat = [(str(c), i, k) for c, s in enumerate(strings) for i, k in enumerate(s)]
    return spark.createDataFrame(flat, "conv_id string, utter_id long, empathy_kind int")


def test_segments_of_all_short_strings(spark, strings):
    got = {(r.conv_id, r.utter_id): r.segment for r in sequence.segment_numbers(rows(spark, strings)).collect()}
    for c, s in enumerate(strings):
        assert [got[str(c), i] for i in range(len(s))] == by_pattern(s), s


def test_flag_of_all_short_strings(spark, strings):
    got = {r.conv_id: r.contain_empathy_seq for r in sequence.sequences(rows(spark, strings)).collect()}
    assert all(got[str(c)] == int("1, 2" in ", ".join(map(str, s))) for c, s in enumerate(strings))


@pytest.mark.parametrize(("labels", "want"), [("122", "00-"), ("1222", "0000"), ("1212", "0000"), ("12212", "00-11"), ("1122", "-00-"), ("0120", "-00-"), ("21", "--"), ("1221222", "00-1111")])
def test_worked_examples(labels, want):
    assert "".join("-" if x is None else str(x) for x in by_pattern([int(c) for c in labels])) == want


def test_rows_in_any_order_nulls_and_renumbering(spark):
    df = spark.createDataFrame([("a", 5, 2), ("a", 3, 1), ("a", 9, None), ("a", 11, 1), ("a", 12, 2), (None, 1, 1), (None, 2, 2)], "conv_id string, utter_id long, empathy_kind int")
    got = sorted((r.new_conv_id, r.new_utter_idx, r.utter_id) for r in sequence.segmented(df).collect())
    assert got == [("a_0", 0, 3), ("a_0", 1, 5), ("a_1", 0, 11), ("a_1", 1, 12)]


def test_rules(spark):
    df = spark.createDataFrame([("a", 0, 1, 0.0), ("a", 1, 2, 0.0), ("b", 0, 2, 1.0)], "conv_id string, utter_id long, empathy_kind int, is_empathy double")
    ids = lambda rule: {r.conv_id for r in sequence.empathetic(df, rule).collect()}
    assert (ids("contain_empathy"), ids("is_empathy"), ids("both")) == ({"a"}, {"b"}, set())
    with pytest.raises(ValueError):
        sequence.empathetic(df, "other")
