"""What the music queries write on their way is small beside their rows, and tables that grow with the catalogue are not broadcast."""

import os
from urllib.parse import urlparse

import pytest

from reelweave.plans import builders as b
from reelweave.registry import QUERIES, document_queries, load_all

load_all()


@pytest.mark.parametrize(("name", "most"), [("build_song_credits", 250), ("build_nominations", 250)])
def test_bytes_written_for_an_order(spark, tmp_path, monkeypatch, name, most):
    orders = 3000
    spark.range(orders).selectExpr("id AS o_orderkey", "id % 97 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    files, plain = [], document_queries.written

    def written(df, **options):
        found = plain(df, **options)
        files.extend(found.inputFiles())
        return found

    monkeypatch.setattr(document_queries, "written", written)
    rows = QUERIES[name](spark, str(tmp_path))
    assert rows.count() == orders * {"build_song_credits": 3, "build_nominations": 2}[name]
    assert sum(os.path.getsize(urlparse(f).path) for f in files) < most * orders


def test_songs_and_albums_are_not_broadcast(spark, table):
    albums = table("id BIGINT, release_title STRING, film_year INT", (1, "Album", 1990))
    tracks = table("release_title STRING, film_year INT, song_title STRING, track_number INT", ("ALBUM", 1990, "Song", 2), ("Album", 1990, "Song", 1))
    songs = b.build_songs(tracks, albums)
    assert [(r.soundtrack_id, r.title, r.track_number) for r in songs.collect()] == [(1, "Song", 1)]
    assert "Broadcast" not in songs._jdf.queryExecution().executedPlan().toString()


def test_the_last_label_and_the_first_release_win(spark, table, values):
    media = table("id BIGINT, title STRING, year INT, media_type STRING", (1, "Album", 1990, "soundtrack"), (2, "a film", 1990, "film"))
    schema = "film STRING, film_year INT, release_position INT, release_title STRING, label STRING"
    releases = table(schema, ("A film", 1990, 0, "ALBUM", None), ("A film", 1990, 1, "album", "old"), ("A film", 1990, 2, "Album", "new"),
                     ("A film", 1990, 3, "Album", None), (None, 1990, 5, "other", "x"), ("A film", None, 0, "Album", "none"))
    found = b.build_soundtracks(releases, media)
    assert values(found, "media_id", "source_media_id", "label", "release_title", "film_year") == [(1, 2, "new", "ALBUM", 1990)]
