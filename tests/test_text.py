from pyspark.sql import functions as F

from reelweave.functions import text as tx


def test_title_year_needs_the_whole_shape(apply):
    texts = ["Far Sky (2004)", "  Far Sky(2004) ", "Two (19) (1999)", "No year", "(2001)", "Late (2001) cut", "Run (21)", None, "\tTab (1990)\n"]
    assert apply(tx.parse_title_year, texts) == [
        ("Far Sky", 2004), ("Far Sky", 2004), ("Two (19)", 1999), None, None, None, None, None, ("Tab", 1990)]


def test_title_year_variants(apply):
    texts = ["Far Sky (2004)", "No year", "Late (2001) cut", None]
    assert apply(tx.title_year_or_raw, texts) == [("Far Sky", 2004), ("No year", None), ("Late (2001) cut", None), None]
    assert apply(tx.title_year_anywhere, texts) == [("Far Sky", 2004), ("No year", 2000), ("Late cut", 2001), None]
    assert apply(lambda c: tx.title_year_anywhere(c, None), ["No year"]) == [("No year", None)]


def test_slugify(apply):
    assert apply(tx.slugify, ["Löwe & Co: The  Hunt!", "--A_b  c--", "", None]) == ["lwe-co-the-hunt", "ab-c", "", None]
    assert apply(lambda c: tx.slugify(c, 50, trim_dashes=False), ["-" + "ab " * 40]) == [("-" + "ab-" * 40)[:50]]


def test_search_has_no_wildcards(apply):
    assert apply(lambda c: tx.contains_any_case([c], "A_%"), ["xa_%y", "abc", None]) == [True, False, False]


def test_title_case_restarts_after_punctuation(apply):
    assert apply(tx.title_case, ["xbox-one x", "o'NEILL 3ds", "a  b"]) == ["Xbox-One X", "O'Neill 3Ds", "A  B"]


def test_keys_and_names(spark, table):
    df = table("film_title STRING, film_year INT", ("Far Sky", 2004))
    assert df.select(tx.key_text(F.col("film_title"), F.col("film_year")).alias("k")).first().k == "far_sky_2004"
    assert df.select(tx.key_text(F.col("film_title"), F.col("film_year"), separator="-", fold=False).alias("k")).first().k == "Far Sky-2004"
    assert tx.camel_case_columns(df).columns == ["filmTitle", "filmYear"]


def test_member_of_json_array(apply):
    assert apply(lambda c: tx.member_of_json_array(c, "a1"), ['["a1","b"]', '["a11"]', "[]", None]) == [True, False, False, None]
