import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text as tx
from shelfwise.functions.similarity import length_bound, match_ratio, shared_letters_bound


def evaluate(spark, fn, *args):
    df = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(fn(*[F.col(f"c{i}") for i in range(len(args))]).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "fn, args, expected",
    [
        (tx.letter_tokens, ("Foo-bar 2x4 été",), ["Foo", "bar", "x", "t"]),
        (tx.taxonomy_tokens, ("Été_ab 9 x",), ["été", "ab", "x"]),
        (tx.keyword_set, ("Steel steel rod ABCD",), ["steel", "abcd"]),
        (tx.normalize_title, ("  A  b\tC ",), "a b c"),
        (tx.normalize_title, (None,), ""),
        (tx.first_token, ("é!x9 b",), "x9"),
        (tx.first_token, ("éé",), "__empty__"),
        (tx.title_template, ('1 3/4" X 0.120" Tube',), '{NUM} {FRAC}" X {NUM}" Tube'),
        (tx.title_template, ("2x4 stud",), "2x4 stud"),
        (tx.title_template, (".5 in",), "{NUM} in"),
        (tx.title_template, ("1.2.3",), "{NUM}{NUM}"),
        (tx.common_prefix, ("abc", "abd"), "ab"),
        (tx.common_prefix, ("abc", "abc"), "abc"),
        (tx.common_prefix, ("ab", "abc"), "ab"),
        (tx.leaf_slug, ("/a/b/c/",), "c"),
        (tx.ancestors, ("a/b/c",), ["a", "a/b"]),
        (tx.ancestors, ("a",), []),
        (tx.slugify, ("  Hot & Cold—Rods! ",), "hot_cold_rods"),
        (tx.rule_method, ("rods",), "t1_bigram"),
        (tx.is_strict_prefix, ("a", "ab/c"), False),
        (tx.is_strict_prefix, ("a", "a/c"), True),
    ],
)
def test_text(spark, fn, args, expected):
    assert evaluate(spark, fn, *args) == expected


@pytest.mark.parametrize(
    "raw, hint, expected",
    [
        ("3 in.", "measurement_inches", "3"),
        ("3 inches", "measurement_inches", "3"),
        ('3"', "measurement_inches", "3"),
        ("3 inch", "measurement_inches", "3 inch"),
        ("3in", "measurement_inches", "3in"),
        ("6 ft", "measurement_feet", "6"),
        ("6'", "measurement_feet", "6"),
        (" RED ", "text_lower", "red"),
        (" Red ", "text_raw", "Red"),
        ("  ", "text_raw", None),
        ("x" * 121, "text_raw", None),
    ],
)
def test_values(spark, raw, hint, expected):
    assert evaluate(spark, tx.normalize_value, raw, hint) == expected


def test_ratio_and_bounds(spark):
    words = ["tide", "diet", "bind", "in", "", "steel rod", "steel rods", "a" * 300 + "b", "b" + "a" * 299]
    pairs = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    from difflib import SequenceMatcher

    got = pairs.select("a", "b", match_ratio("a", "b").alias("r"), length_bound(F.col("a"), F.col("b")).alias("l"),
                       shared_letters_bound(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        want = 1.0 if r.a == r.b else SequenceMatcher(None, r.a, r.b).ratio()
        assert r.r == pytest.approx(want)
        if r.a and r.b:
            assert want <= r.l + 1e-9 and want <= r.s + 1e-9
    by = {(r.a, r.b): r.r for r in got}
    assert by["tide", "diet"] == 0.25 and by["diet", "tide"] == 0.5


def test_fenced_json(spark):
    for text in ('[{"a": 1}]', 'Sure:\n```json\n[{"a": 1}]\n```', '```\n[{"a": 1}]\n```', '```JSON [{"a": 1}]```'):
        df = spark.createDataFrame([(text,)], "t string").select(F.to_json(tx.json_or_fenced(F.col("t"))).alias("j"))
        assert df.first()["j"] == '[{"a":1}]'
    assert spark.createDataFrame([("nope",)], "t string").select(tx.json_or_fenced(F.col("t")).isNull().alias("n")).first()["n"]
