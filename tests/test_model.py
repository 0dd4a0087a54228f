"""Every view, mart and named query runs on tables of the declared schemas, empty ones too."""

import inspect

import pytest

from reelweave.plans import boxoffice, insights, marts, people, views
from reelweave.plans.tables import Tables
from reelweave.schemas import TABLES


def named():
    for module in (views, marts, boxoffice, people, insights):
        for name, fn in vars(module).items():
            if inspect.isfunction(fn) and fn.__module__ == module.__name__ and not name.startswith("_"):
                first, *rest = inspect.signature(fn).parameters.values()
                if first.name == "t" and all(p.default is not p.empty for p in rest):
                    yield pytest.param(fn, id=f"{module.__name__.rpartition('.')[2]}.{name}")


@pytest.mark.parametrize("fn", list(named()))
def test_runs_on_declared_tables(spark, tmp_path, fn):
    result = fn(Tables.from_parquet(spark, str(tmp_path)))
    frames = result if isinstance(result, (list, tuple)) else [result]
    for frame in frames:
        assert frame.limit(5).collect() is not None


def test_tables_are_declared_once():
    assert {"games", "soundtracks", "songs", "song_credits", "nominations", "game_sales", "species"} <= set(TABLES)
