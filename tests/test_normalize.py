from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz


def test_roles(apply):
    raw = [" Main Protagonist ", "Henchmen", "narrator", None, "", "Comic Relief"]
    assert apply(nz.role_alias, raw) == ["protagonist", "henchmen", "narrator", "supporting", "", "comic relief"]
    assert apply(nz.role_closed, raw) == ["supporting", "henchman", "supporting", "supporting", "supporting", "comic_relief"]
    assert apply(nz.role_by_rules, raw) == ["supporting", "henchman", "supporting", "minor", "minor", "comic_relief"]


def test_genders(apply):
    raw = ["MALE", "girl", "mixed", "unknown", None, "robot"]
    assert apply(nz.gender_alias, raw) == ["male", "female", "mixed", "n/a", "n/a", "robot"]
    assert apply(nz.gender_closed, raw) == ["male", "n/a", "various", "n/a", "n/a", "n/a"]
    assert apply(nz.gender_by_rules, raw) == ["male", "unknown", "mixed", "unknown", "unknown", "unknown"]


def test_species_order_is_longest_then_alphabetical(apply):
    raw = ["Woolly Mammoth", "toy (rag doll)", "blue tang fish", "giant clownfish", "anthropomorphic cow", "anthropomorphic dog",
           "Gremlin", "unicorn", "", None, "robot cat", "enchanted object"]
    assert apply(nz.species_name, raw) == [
        "mammoth", "toy", "blue tang", "clownfish", "cow", "dog", "fairy", "unicorn", None, None, "robot", "enchanted object"]
    assert apply(nz.species_name, ["giant"]) == ["ant"]
    assert apply(lambda c: nz.species_name(c, whole_words=True), ["giant", "old cat"]) == ["giant", "cat"]


def test_species_parts(apply):
    raw = ["Toy (Rag Doll)", "saber-toothed squirrel", "anthropomorphic duck", None, "human (a) (b)", "fish ()"]
    assert apply(nz.species_parts, raw) == [
        ("toy", "rag doll", False), ("squirrel", "saber-toothed", False), ("duck", None, True), (None, None, False),
        ("human", "a", False), ("fish", "", False)]
    exact = sorted(fv.SPECIES_EXACT)
    assert apply(nz.species_parts, exact) == [fv.SPECIES_EXACT[raw] for raw in exact]


def test_species_buckets(apply):
    raw = ["Superhuman", "Bird of prey", "talking car", "catcar", "", None]
    assert apply(nz.species_bucket, raw) == ["human", "animal", "car", "animal", "unknown", "unknown"]
    assert apply(nz.species_group, raw) == ["Human", "Animal", "Other", "Animal", "Other", "Other"]


def test_actor_names(apply):
    raw = ["Ann Lee, Bob Ray", "Cyd Poe (singing)", "Lee Roy, jr.", "N/A", "none", "", None, "Jo (young), Di Oz (old)", "(crowd)"]
    assert apply(nz.primary_actor, raw) == ["Ann Lee", "Cyd Poe", "Lee Roy, jr.", None, None, None, None, "Jo", None]
    assert apply(nz.first_actor, ["Ann Lee, Bob", "Cyd (x), Di", None]) == ["Ann Lee", "Cyd", None]
    assert apply(nz.is_real_name, ["Ann", "TBA", "null", "", None]) == [True, False, False, False, False]


def test_platforms(apply):
    assert apply(nz.platforms, ["PC/PS3, wii", "pc,PC", "vectrex-mini", "", None]) == [
        ["Nintendo Wii", "PC", "PlayStation 3"], ["PC"], ["Vectrex-Mini"], [], []]


def test_awards_and_credits(apply):
    assert apply(nz.award_body, ["Oscar night", None, "", "Golden Globe, Annie", "City Prize"]) == [
        "Academy Awards", "Academy Awards", "Academy Awards", "Golden Globe Awards", "City Prize"]
    assert apply(nz.credit_type, ["Voice", "SINGER", "Composer", None]) == ["performer", "performer", "composer", None]
    assert apply(nz.outcome, ["won", "Won", None]) == ["won", "nominated", "nominated"]


def test_studios(spark, table):
    rows = table("studio STRING, folder STRING", ("WDAS", "x"), ("The Fox Lot", "x"), ("Own House", "x"), (None, "pixar_characters"), (None, "x"))
    names = [r.n for r in rows.select(nz.studio_name(F.col("studio"), F.col("folder")).alias("n")).collect()]
    assert names == ["Walt Disney Animation Studios", "20th Century Animation", "Own House", "Pixar Animation Studios", None]


def test_studio_facts_and_types(apply):
    assert apply(nz.studio_facts, ["Blue Sky Studios", "Own House", None]) == [
        (1987, 2021, "closed"), (2000, None, "active"), (2000, None, "active")]
    assert apply(lambda c: nz.animation_type(F.lit(None).cast("string"), c), ["The Enchanted Hill", "Far Sky"]) == ["hybrid", "fully_animated"]
    assert apply(nz.publisher, ["A / B/ C", "A"]) == ["A", "A"]
    assert apply(nz.developer, ["A / B/ C", "A"]) == ["C", None]
