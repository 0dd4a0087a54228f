"""Award categories: the first use decides the level."""

from reelweave.plans import builders as b


def test_first_use_decides_the_level(table, values):
    awards = table(
        "film STRING, film_year INT, award_body STRING, category STRING, song_title STRING",
        ("A", 2000, "Prize", "X", "song"), ("B", 2001, "Prize", "X", None), ("A", 2000, "Prize", "Y", "song"), ("A", 2000, "Prize", "Y", None),
        ("C", 2001, "Prize", "Z", "song"), ("B", 2005, "Prize", "Z", None), ("A", 2000, "Prize", "Known", "song"),
    )
    bodies = table("id BIGINT, name STRING", (1, "Prize"))
    known = table("id BIGINT, award_body_id BIGINT, name STRING, is_media_level BOOLEAN", (1, 1, "Known", True))
    built = b.build_award_categories(awards, bodies, known)
    assert values(built, "name", "is_media_level") == [("Known", True), ("X", False), ("Y", True), ("Z", True)]


def test_last_label_wins(table, values):
    releases = table(
        "film STRING, film_year INT, release_title STRING, release_position INT, label STRING",
        ("F", 2000, "Album", 0, None), ("F", 2000, "Album", 1, "Old"), ("F", 2000, "ALBUM", 2, "New"), ("F", 2000, "Album", 3, None),
    )
    media = table("id BIGINT, title STRING, year INT, franchise_id BIGINT, media_type STRING", (1, "Album", 2000, 1, "soundtrack"), (2, "F", 2000, 1, "film"))
    assert values(b.build_soundtracks(releases, media), "media_id", "source_media_id", "label") == [(1, 2, "New")]
