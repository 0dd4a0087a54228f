"""Declared schemas of raw records and conformed tables (Spark DDL)."""

RAW_FILMS = (
    "title STRING, year INT, studio STRING, studio_founded INT, studio_closed INT, studio_status STRING, "
    "franchise STRING, animation_type STRING, source_file STRING, extracted_at TIMESTAMP"
)
RAW_CHARACTERS = (
    "name STRING, franchise STRING, role STRING, gender STRING, species STRING, voice_actor STRING, "
    "first_appearance_year INT, appearances ARRAY<STRUCT<title: STRING, year: INT>>, source_dir STRING, "
    "source_file STRING, extracted_at TIMESTAMP"
)
RAW_BOX_OFFICE = (
    "film_title STRING, film_year INT, franchise STRING, report_date STRING, state_code STRING, revenue DOUBLE, "
    "days_since_release INT, week_number INT, is_weekend BOOLEAN, generated_at TIMESTAMP"
)
REVENUE_EVENT = (
    "event_type STRING, film_id BIGINT, film_title STRING, film_year INT, report_date STRING, state_code STRING, "
    "revenue DOUBLE, timestamp TIMESTAMP"
)

AWARD = "STRUCT<award: STRING, category: STRING, year: INT, result: STRING>"
PERFORMER = "STRUCT<name: STRING, type: STRING, character: STRING>"
TRACK = (
    f"STRUCT<title: STRING, type: STRING, composer: STRING, performers: ARRAY<{PERFORMER}>, awards: ARRAY<{AWARD}>>"
)
RELEASE = (
    "STRUCT<title: STRING, label: STRING, conductor: STRING, composers: ARRAY<STRING>, "
    f"album_awards: ARRAY<{AWARD}>, tracks: ARRAY<{TRACK}>>"
)
SOUNDTRACK_ENTRY = f"film STRING, film_year INT, releases ARRAY<{RELEASE}>"
SHORT = (
    "STRUCT<title: STRING, year: INT, studio: STRING, directors: ARRAY<STRING>, released_with: STRING, "
    "released_with_year: INT, notes: STRING>"
)

TABLES = {
    "studios": "id BIGINT, name STRING, years_active_start INT, years_active_end INT, status STRING",
    "franchises": "id BIGINT, name STRING, studio_id BIGINT",
    "media": "id BIGINT, title STRING, year INT, franchise_id BIGINT, media_type STRING",
    "films": "id BIGINT, media_id BIGINT, studio_id BIGINT, animation_type STRING",
    "roles": "id BIGINT, name STRING",
    "genders": "id BIGINT, name STRING",
    "talent": "id BIGINT, name STRING",
    "characters": (
        "id BIGINT, name STRING, franchise STRING, role_id BIGINT, gender_id BIGINT, species STRING, "
        "first_appearance_year INT, studio_id BIGINT, species_id BIGINT, species_subtype STRING, is_anthropomorphic BOOLEAN"
    ),
    "games": "id BIGINT, media_id BIGINT, developer STRING, publisher STRING, platforms ARRAY<STRING>",
    "platforms": "id BIGINT, name STRING",
    "game_platforms": "game_id BIGINT, platform_id BIGINT",
    "game_sales": "game_id BIGINT, units_sold BIGINT, revenue DECIMAL(14,2)",
    "soundtracks": (
        "id BIGINT, media_id BIGINT, source_media_id BIGINT, label STRING, release_title STRING, film_year INT"
    ),
    "songs": "id BIGINT, soundtrack_id BIGINT, title STRING, track_number INT",
    "credit_types": "id BIGINT, name STRING",
    "song_credits": "id BIGINT, song_id BIGINT, talent_id BIGINT, credit_type_id BIGINT",
    "award_bodies": "id BIGINT, name STRING",
    "award_categories": "id BIGINT, award_body_id BIGINT, name STRING, is_media_level BOOLEAN",
    "nominations": (
        "id BIGINT, media_id BIGINT, award_category_id BIGINT, year INT, outcome STRING, talent_id BIGINT, song_id BIGINT"
    ),
    "species": "id BIGINT, name STRING, parent_species_id BIGINT",
    "character_appearances": (
        "id BIGINT, character_id BIGINT, media_id BIGINT, talent_id BIGINT, role_id BIGINT, variant STRING, notes STRING"
    ),
    "box_office_daily": (
        "id BIGINT, film_id BIGINT, film_title STRING, film_year INT, report_date DATE, state_code STRING, "
        "revenue DECIMAL(14,2), week_number INT, is_weekend BOOLEAN"
    ),
    "box_office_weekly": (
        "id BIGINT, film_id BIGINT, film_title STRING, film_year INT, week_number INT, total_revenue DECIMAL(24,2), "
        "avg_daily_revenue DOUBLE, days_reporting BIGINT, distinct_days BIGINT, weekend_revenue DECIMAL(24,2), "
        "weekday_revenue DECIMAL(24,2), states_reporting BIGINT, prev_week_revenue DECIMAL(24,2), wow_change DOUBLE"
    ),
    "box_office_total": (
        "id BIGINT, film_id BIGINT, film_title STRING, film_year INT, total_revenue DECIMAL(24,2), "
        "first_report_date DATE, last_report_date DATE, weeks_in_release INT, days_in_release BIGINT, "
        "states_reached BIGINT, opening_week_revenue DECIMAL(24,2), avg_daily_revenue DOUBLE"
    ),
}

# Columns that may not be null in a record, and columns with a closed set of values.
RECORD_CONTRACTS = {
    "film": {
        "required": ["title", "year", "studio", "franchise", "animation_type", "source_file"],
        "allowed": {"animation_type": ["fully_animated", "hybrid"]},
    },
    "character": {"required": ["name", "franchise", "role", "source_file"], "allowed": {}},
    "box_office": {
        "required": ["film_title", "film_year", "report_date", "state_code", "revenue", "week_number"],
        "allowed": {},
    },
}

# Constraints of conformed tables: columns that may not be null, closed value sets, and ids that are hashes of a unique key.
TABLE_CONTRACTS = {
    "studios": {"required": ["id", "name"], "allowed": {"status": ["active", "closed"]}, "unique_id": True},
    "franchises": {"required": ["id", "name"], "unique_id": True},
    "media": {
        "required": ["id", "title", "year", "media_type"], "allowed": {"media_type": ["film", "game", "soundtrack"]},
        "unique_id": True,
    },
    "films": {
        "required": ["id", "media_id"], "allowed": {"animation_type": ["fully_animated", "hybrid"]}, "unique_id": True,
    },
    "games": {"required": ["id", "media_id"], "unique_id": True},
    "platforms": {"required": ["id", "name"], "unique_id": True},
    "game_platforms": {"required": ["game_id", "platform_id"]},
    "talent": {"required": ["id", "name"], "unique_id": True},
    "species": {"required": ["id", "name"], "unique_id": True},
    "characters": {"required": ["id", "name", "franchise", "is_anthropomorphic"], "unique_id": True},
    "character_appearances": {"required": ["id", "character_id", "media_id"]},
    "soundtracks": {"required": ["id", "media_id"], "unique_id": True},
    "songs": {"required": ["id", "soundtrack_id", "title"], "unique_id": True},
    "song_credits": {"required": ["id", "song_id", "talent_id", "credit_type_id"]},
    "award_bodies": {"required": ["id", "name"], "unique_id": True},
    "award_categories": {"required": ["id", "award_body_id", "name", "is_media_level"], "unique_id": True},
    "nominations": {
        "required": ["id", "media_id", "award_category_id", "outcome"], "allowed": {"outcome": ["nominated", "won"]},
    },
    "box_office_daily": {"required": ["id", "report_date", "state_code", "revenue"]},
    "box_office_weekly": {"required": ["id", "week_number", "total_revenue"]},
    "box_office_total": {"required": ["id", "total_revenue"]},
}
