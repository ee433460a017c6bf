"""Markup and classification against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from sourceground.functions import classify as K
from sourceground.functions import text as X


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("桂枝<l>三兩</l>((一作\n二兩))去皮", "桂枝三兩去皮"),
        ("見[[book:某書:]]。", "見某書。"),
        ("[[page:book:]]", ""),
        ("**方名**與__題記__", "方名與題記"),
        ("甲<#/>乙<z>丙</z>　　　丁 a b", "甲乙丙　丁ab"),
        ("　首尾 ", "首尾"),
        ("<l>一\n錢</l>", "一\n錢"),
    ],
)
def test_strip_inline(spark, raw, clean):
    assert one(spark, X.strip_inline(F.col("t")), t=raw) == clean


def test_strip_takes_all_white_space_of_unicode(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert sorted(X.SPACES) == spaces
    for t in ("", "".join(spaces), "".join(spaces) + "甲 \u3000乙" + "".join(spaces), "甲", "\u200b甲\u200b"):
        assert one(spark, X.strip(F.col("t")), t=t) == t.strip()
    assert one(spark, X.strip(F.col("t").cast("string")), t=None) is None


def test_normalize_and_punctuation(spark):
    assert one(spark, X.normalize(F.col("t")), t="桂枝<l>三兩</l>，A_1。") == "桂枝A_1"
    assert one(spark, X.remove_punctuation(F.col("t")), t="甲，乙。「丙」\"d\"　'e'") == "甲乙丙de"


def test_formula(spark):
    body = "**某湯方：**\n人參<l>三兩，去蘆</l>附子<l>一枚</l>甘草<l></l>"
    f = one(spark, X.parse_formula(F.col("t")), t=body)
    assert f.formula_name == "某湯"
    assert [tuple(i) for i in f.ingredients] == [("人參", "三兩", "去蘆"), ("附子", "一枚", None), ("甘草", None, None)]
    assert one(spark, X.formula_name(F.col("t")), t="無名") is None


@pytest.mark.parametrize(("line", "title", "signs"), [("=== 題 ===", "題", 3), ("====== 題 ======　", "題", 6), ("== 題 ==", None, None), ("==== 題 ===", "=題", 3), ("=== 題", None, None)])
def test_heading(spark, line, title, signs):
    got = one(spark, X.heading_signs(F.col("t")), t=line)
    assert got == signs
    if signs:
        assert one(spark, X.heading_title(F.col("t")), t=line) == title


def test_json_object(spark):
    get = F.try_variant_get(X.json_object(F.col("t")), "$.a", "string")
    assert one(spark, get, t='before {"a": "x"} after') == "x"
    assert one(spark, get, t="none") is None
    assert one(spark, get, t='{"a": broken') is None


@pytest.mark.parametrize(("raw", "tier"), [("90%", "test"), ("79.9%", "candidate"), ("20", "explore"), ("0%", "unscored"), ("x", "unscored"), ("", "unscored"), ("nan", "unscored"), (None, "unscored")])
def test_quality_tier(spark, raw, tier):
    assert one(spark, K.quality_tier(F.col("t").cast("string")), t=raw) == tier


@pytest.mark.parametrize(("raw", "level"), [("傷寒 金匱", "傷寒金匱類"), ("　本草", "本草類"), ("怪", "其他"), ("", "未分類"), (None, "未分類")])
def test_category(spark, raw, level):
    assert one(spark, K.category_level_1(F.col("t").cast("string")), t=raw) == level
    assert one(spark, K.candidate_tasks(F.lit(level)))[0] == "T1"
