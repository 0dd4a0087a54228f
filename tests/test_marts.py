"""Studio statistics against a plain count, and what meets the studios."""

import re

import pytest

import __spark_entry__ as entry
from reelweave.plans import marts

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("value", ["voices", "talent_id"])
def test_values_of_shared_franchises(table, values, value):
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "z"), ("c", "w"), ("b", "z"), ("nobody's", "v"), ("d", None), ("a", None)]
    owners = [("a", "one"), ("a", "two"), ("b", "two"), ("c", "three"), ("empty", "four"), ("d", "five")]
    counted = marts._owned_distinct(
        table(f"franchise STRING, {value} STRING", *rows), value, table("franchise STRING, studio_name STRING", *owners), "n")
    seen = {}
    for franchise, studio in owners:
        seen.setdefault(studio, set()).update(v for f, v in rows if f == franchise)
    assert values(counted, "studio_name", "n") == sorted((s, len(v - {None})) for s, v in seen.items() if v)


def test_values_are_not_laid_out_per_studio(spark):
    """Voice lists and voices were shuffled once for each studio of their franchises."""
    plan = entry.queries()["studio_stats"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((.*)", plan)
    assert any("studio_name" in k for k in keys)
    assert not [k for k in keys if "studio_name" in k and re.search("voices|talent_id", k)]
