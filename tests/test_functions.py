"""Expressions against plain Python."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscale.functions import cells, fuzzy, keys, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_stable_hash(spark):
    assert one(spark, keys.stable_hash(F.lit("a"), F.lit(None), F.lit(7))) == keys.stable_hash_value("a", None, 7)
    with pytest.raises(KeyError):
        keys.stable_key("nothing")


def test_config_hash_changes():
    assert keys.config_hash({"a": 1, "b": 2}) == keys.config_hash({"b": 2, "a": 1}) != keys.config_hash({"a": 2, "b": 2})


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i][j] = d[i - 1][j - 1] + 1 if x == y else max(d[i - 1][j], d[i][j - 1])
    assert fuzzy.lcs_length(a, b) == d[-1][-1]


def test_indel_ratio(spark):
    assert round(fuzzy.indel_ratio_value("this is a test", "this is a test!"), 2) == 96.55
    assert fuzzy.indel_ratio_value("", "") == 100.0
    assert fuzzy.indel_ratio_value(None, "x") is None
    assert round(one(spark, fuzzy.indel_ratio(F.lit("abcd"), F.lit("abxd"))), 1) == 75.0
    assert one(spark, fuzzy.digits_equal(F.lit("Chapter 11"), F.lit("Chapter 12"))) is False


@pytest.mark.parametrize(
    "line, want",
    [("Fireball ....... 123", ("Fireball", 123)), ("Monsters, 12, 14", ("Monsters", 14)), ("abc", None), ("Zero ... 0", None), ("12345", None), ("Spells … 7", ("Spells", 7)), (None, None)],
)
def test_toc_line(spark, line, want):
    got = one(spark, text.toc_line(F.lit(line).cast("string")))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("word, level", [("1st", 1), ("2nd)", 2), ("9th", 9), ("4x", None), ("first", None)])
def test_ordinals(spark, word, level):
    assert one(spark, text.ordinal_level(F.lit(word))) == level


def test_fields(spark):
    c = F.lit("intro Range: 5\n  duration: \nDuration: 1 turn")
    assert one(spark, text.field_line(c, "Range")) is None
    assert one(spark, text.field_anywhere(c, "Range")) == "5"
    assert one(spark, text.field_anywhere(c, "Sphere")) == ""


def test_text_pieces(spark):
    assert one(spark, text.strip(F.lit(" \t a b \n"))) == "a b"
    assert one(spark, text.slug(F.lit("Magic Missile!"))) == "magic_missile"
    assert one(spark, text.rejoin_hyphens(F.lit("mag-\nic and Two-\nWord ‘x’"))) == "magic and Two-\nWord 'x'"
    assert one(spark, text.clean_for_matching(F.lit("## *Fly* (Alteration) "))) == "Fly"
    assert one(spark, text.without_leading_title(F.lit("Magic   missile: text"), F.lit("magic Missile"))) == "text"
    assert one(spark, text.replace_ignoring_case(F.lit("a.B a.b axb"), "A.b", "$1")) == "$1 $1 axb"
    assert one(spark, text.occurrences(F.lit("a b  a  B"), F.lit("A B"))) == 2
    assert one(spark, text.occurrences(F.lit("x"), F.lit(" "))) == 9999
    assert one(spark, text.whole_word_position(F.lit("scats cat"), "cat")) == 7
    assert one(spark, text.line_at(F.lit("ab\ncd\nef"), F.lit(4))) == "cd"
    assert one(spark, text.heading_score(F.lit("x\n\nFly\ntext"), F.lit(4), F.lit("Fly"))) == 3
    assert one(spark, text.link_table_references(F.lit("see Table 12."))) == "see [Table 12](#table-12)."
    assert [one(spark, text.duration_text(F.lit(s))) for s in (5, 125, 3720)] == ["5s", "2m 5s", "1h 2m"]


def test_cells(spark):
    assert one(spark, cells.decode_cells(F.lit('["a","b"]'))) == ["a", "b"]
    assert one(spark, cells.decode_cells(F.lit("plain"))) == ["plain"]
    assert one(spark, cells.table_row(F.lit('["<b>a</b>","b  c"]'))) == "| a | b c |"
    assert one(spark, cells.page_list(F.lit("3, 4,,7"))) == [3, 4, 7]
    assert one(spark, cells.answer_object(F.lit('so: {"combat": true} ok'), "combat boolean, popular boolean")).combat is True
    assert [r.wrong for r in one(spark, cells.ocr_corrections(F.lit('x [{"wrong":"teh","correct":"the"},{"wrong":"a","correct":"a"}]')))] == ["teh"]
    assert one(spark, cells.ocr_corrections(F.lit("nothing"))) == []
    assert [one(spark, cells.name_cell_ok(F.lit(x))) for x in ("Long sword", "15 gp", "+2", "Table 4", "ab")] == [True, False, False, False, False]
