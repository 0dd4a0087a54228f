"""The conformed catalogue as seen in the given tables: each view as a DataFrame and as SQL.

A part is a title, a brand a studio, a part type a franchise, a customer a character, a supplier a voice actor, a line
item an appearance and a box-office report; an order is a nomination and an event a revenue report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.functions import normalize as nz
from reelweave.operators.keys import first_per_key, surrogate_key
from reelweave.plans import boxoffice as bo
from reelweave.plans.tables import Tables
from reelweave.sources import readers

def franchise_id(kind):
    return (F.ascii(kind) * 1000 + F.length(kind)).cast("bigint")


def brand_number(brand):
    return F.substring(brand, 7, 10).cast("bigint")


class Catalogue(Tables):
    """Conformed tables derived from the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._raw_schemas: dict = {}
        super().__init__(lambda name: getattr(self, f"make_{name}")())

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def raw(self, name: str) -> DataFrame:
        """A given table; its footer is looked at once per catalogue."""
        path = f"{self._folder}/{name}.parquet"
        if name not in self._raw_schemas:
            self._raw_schemas[name] = self._spark.read.parquet(path).schema
        return self._spark.read.schema(self._raw_schemas[name]).parquet(path)

    # ---- lookups

    def make_roles(self):
        return readers.roles(self._spark)

    def make_genders(self):
        return readers.genders(self._spark)

    def make_credit_types(self):
        return readers.credit_types(self._spark)

    def make_award_bodies(self):
        return readers.award_bodies(self._spark)

    def make_award_categories(self):
        return readers.award_categories(self._spark)

    # ---- titles

    def make_media(self):
        key = F.col("p_partkey")
        kind = F.when(key % 3 == 0, "game").when(key % 10 == 7, "soundtrack").otherwise("film")
        return self.raw("part").select(
            key.alias("id"), F.concat_ws(" ", "p_name", key).alias("title"),
            (F.col("p_size") + 1970).cast("int").alias("year"), franchise_id("p_type").alias("franchise_id"),
            kind.alias("media_type"),
        )

    def make_films(self):
        key = F.col("p_partkey")
        return self.raw("part").filter((key % 3 != 0) & (key % 10 != 7)).select(
            key.alias("id"), key.alias("media_id"), brand_number("p_brand").alias("studio_id"),
            F.when(F.col("p_size") % 5 == 0, "hybrid").otherwise("fully_animated").alias("animation_type"),
        )

    def make_studios(self):
        number = brand_number("name")
        closed = number % 2 == 1
        return self.raw("part").select(F.col("p_brand").alias("name")).distinct().select(
            number.alias("id"), "name", (number + 1900).cast("int").alias("years_active_start"),
            F.when(closed, (number + 1990).cast("int")).alias("years_active_end"),
            F.when(closed, "closed").otherwise("active").alias("status"),
        )

    def make_franchises(self):
        """Franchises; the studio is the first one that made a title of it."""
        return self.raw("part").groupBy(F.col("p_type").alias("name")).agg(
            F.min(brand_number("p_brand")).alias("studio_id")
        ).select(franchise_id("name").alias("id"), "name", "studio_id")

    def make_games(self):
        key = F.col("p_partkey")
        owner = F.concat_ws("/", "p_brand", "p_type")
        device = F.element_at(F.array(F.lit("PS2/Xbox 360"), F.lit("PC"), F.lit("Nintendo DS, Wii")), F.col("p_size") % 3 + 1)
        return self.raw("part").filter(key % 3 == 0).select(
            key.alias("id"), key.alias("media_id"), nz.developer(owner).alias("developer"),
            nz.publisher(owner).alias("publisher"), nz.platforms(device).alias("platforms"),
        )

    def make_platforms(self):
        names = [*fv.PLATFORMS, "Nintendo Wii"]
        return readers.small_table(self._spark, list(enumerate(names, start=1)), "id BIGINT, name STRING")

    def make_game_platforms(self):
        links = self.games.select(F.col("id").alias("game_id"), F.explode("platforms").alias("name"))
        return links.join(self.platforms.select(F.col("id").alias("platform_id"), "name"), "name").drop("name")

    def make_game_sales(self):
        return self.raw("lineitem").filter(F.col("l_partkey") % 3 == 0).select(
            F.col("l_partkey").alias("game_id"), F.col("l_quantity").cast("bigint").alias("units_sold"),
            F.col("l_extendedprice").cast("decimal(14,2)").alias("revenue"),
        )

    # ---- people

    def make_talent(self):
        return self.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    def make_characters(self):
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        part = self.raw("part").select(F.col("p_partkey").alias("c_custkey"), "p_type", "p_brand", "p_size")
        rows = self.raw("customer").join(part, "c_custkey", "left").join(nation, "c_nationkey", "left")
        key = F.col("c_custkey")
        return rows.select(
            key.alias("id"), F.col("c_name").alias("name"), F.col("p_type").alias("franchise"),
            F.when(key % 17 != 0, key % len(fv.ROLES) + 1).cast("bigint").alias("role_id"),
            F.when(F.col("c_nationkey") != 3, F.col("c_nationkey") % 3 + 1).cast("bigint").alias("gender_id"),
            F.when(F.col("c_nationkey") != 24, F.col("n_name")).alias("species"),
            (F.col("p_size") + 1970).cast("int").alias("first_appearance_year"),
            brand_number("p_brand").alias("studio_id"),
            F.when(F.col("c_nationkey") % 6 == 1, F.col("c_nationkey") % 5 + 1).cast("bigint").alias("species_id"),
            F.when(key % 7 == 0, F.concat(F.lit("form "), key % 3)).alias("species_subtype"),
            (key % 4 == 0).alias("is_anthropomorphic"),
        )

    def make_species(self):
        return readers.species(self._spark)

    def appearance_rows(self):
        """All line items as appearances, several per (character, title)."""
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("character_id"))
        role = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 5).otherwise(4)
        return self.raw("lineitem").join(orders, "l_orderkey").select(
            "character_id", F.col("l_partkey").alias("media_id"), F.col("l_suppkey").alias("talent_id"),
            role.cast("bigint").alias("role_id"), F.col("l_linestatus").alias("notes"),
        )

    def make_character_appearances(self):
        """One row per character and title, in the order the junction builder uses.

        Rows are dealt out by number, like reduced reports: merged by bytes, a task's rows would grow with the input. A pair has
        few line items, so none is hot.
        """
        pair = ["character_id", "media_id"]
        rows = self.appearance_rows().repartition(1 + self.raw("lineitem").count() // bo.ROWS, *pair)
        kept = first_per_key(rows, pair, ["talent_id", "role_id", "notes"])
        return kept.select(
            surrogate_key("character_id", "media_id").alias("id"), "character_id", "media_id", "talent_id", "role_id",
            F.lit(None).cast("string").alias("variant"), "notes",
        )

    def make_dashboard_films(self):
        return self.films.join(self.media.select(F.col("id").alias("media_id"), "title", "year"), "media_id").select(
            F.concat(F.lit("film-"), F.col("id")).alias("id"), "title", "year", "studio_id"
        )

    def make_dashboard_characters(self):
        """Characters with role and gender by name and a JSON list of film ids."""
        named = self.characters.join(self.roles.select(F.col("id").alias("role_id"), F.col("name").alias("role")), "role_id", "left")
        named = named.join(self.genders.select(F.col("id").alias("gender_id"), F.col("name").alias("gender")), "gender_id", "left")
        film = [F.concat(F.lit("film-"), n) for n in (F.col("id"), F.col("id") * 2 + 1)]
        actor = F.when(F.col("id") % 11 == 0, "N/A").when(
            F.col("id") % 5 != 0, F.concat(F.lit("Actor "), F.col("id") % 89, F.lit(", Second Name (guest)"))
        )
        return named.select(
            "id", "name", "role", "gender", "species", "franchise", "studio_id", actor.alias("voice_actor"),
            F.to_json(F.array(*film)).alias("film_ids"),
        )

    # ---- box office

    def box_office_reports(self):
        """Line items as state reports of a film's revenue."""
        home = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("state_code")
        )
        price, discount = F.col("l_extendedprice").cast("decimal(14,2)"), F.col("l_discount").cast("decimal(4,2)")
        return self.raw("lineitem").join(home, "l_suppkey").select(
            F.col("l_partkey").alias("film_id"), F.to_date("l_shipdate").alias("report_date"), "state_code",
            (price * (1 - discount)).alias("revenue"),
        )

    def make_box_office_daily(self):
        """Reports with release week, weekend flag and title."""
        return bo.release_calendar(self.box_office_reports(), ["film_id"], attributes=self.film_titles())

    def film_titles(self):
        return self.media.select(F.col("id").alias("film_id"), F.col("title").alias("film_title"), F.col("year").alias("film_year"))

    def make_box_office_days(self):
        """One row per title, date and state; weekly and total facts share it, so the line items are read once."""
        reduced = bo.reduce_reports(self.box_office_reports(), ["film_id"])
        return bo.release_calendar(reduced, ["film_id"], attributes=self.film_titles(), reduced=True)

    def make_box_office_weekly(self):
        return bo.weekly_facts(self.box_office_days)

    def make_box_office_total(self):
        return bo.film_facts(self.box_office_days)

    def event_reports(self):
        """Events as revenue reports: user = film, event type = state."""
        return self.raw("events").select(
            F.col("user_id").alias("film_id"), F.to_date("ts").alias("report_date"), F.col("event_type").alias("state_code"),
            F.col("value").cast("decimal(14,2)").alias("revenue"), "event_id", "ts",
        )

    # ---- music and awards

    def make_soundtracks(self):
        key = F.col("p_partkey")
        return self.raw("part").filter((key % 3 != 0) & (key % 10 == 7)).select(
            key.alias("id"), key.alias("media_id"), (key - 1).alias("source_media_id"), F.col("p_brand").alias("label")
        )

    def album_lines(self):
        key = F.col("l_partkey")
        return self.raw("lineitem").filter((key % 3 != 0) & (key % 10 == 7))

    def make_songs(self):
        number = F.col("l_linenumber")
        return self.album_lines().select("l_partkey", number).distinct().select(
            (F.col("l_partkey") * 100 + number).alias("id"), F.col("l_partkey").alias("soundtrack_id"),
            F.concat(F.lit("Song "), number).alias("title"), number.alias("track_number"),
        )

    def make_song_credits(self):
        kind = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).otherwise(3)
        return self.album_lines().select(
            (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("song_id"), F.col("l_suppkey").alias("talent_id"),
            kind.cast("bigint").alias("credit_type_id"),
        ).distinct()

    def make_nominations(self):
        result = F.when(F.col("o_orderstatus") == "F", "won").when(F.col("o_orderstatus") == "O", "nominated").otherwise("pending")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("media_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("award_category_id"),
            F.year("o_orderdate").alias("year"), nz.outcome(result).alias("outcome"),
            F.col("o_custkey").alias("talent_id"), (F.col("o_custkey") * 100 + 1).alias("song_id"),
        )


def _values(names: list[str]) -> str:
    rows = ", ".join("({}, '{}')".format(i, n.replace("'", "''")) for i, n in enumerate(names, start=1))
    return f"SELECT CAST(id AS BIGINT) AS id, name FROM (VALUES {rows}) AS v(id, name)"


_CATEGORY_ROWS = ", ".join(
    "({}, {}, '{}', {})".format(i, fv.AWARD_BODIES.index(body) + 1, name.replace("'", "''"), level)
    for i, (body, name, level) in enumerate(fv.AWARD_CATEGORIES, start=1)
)

# The same views as SQL: name -> (views it reads, text).
VIEWS: dict[str, tuple[list[str], str]] = {
    "roles": ([], _values(fv.ROLES)),
    "genders": ([], _values(fv.GENDERS)),
    "credit_types": ([], _values(fv.CREDIT_TYPES)),
    "award_bodies": ([], _values(fv.AWARD_BODIES)),
    "award_categories": (
        [],
        "SELECT CAST(id AS BIGINT) AS id, CAST(award_body_id AS BIGINT) AS award_body_id, name, is_media_level "
        f"FROM (VALUES {_CATEGORY_ROWS}) AS v(id, award_body_id, name, is_media_level)",
    ),
    "platforms": ([], _values([*fv.PLATFORMS, "Nintendo Wii"])),
    "media": (
        [],
        """SELECT p_partkey AS id, p_name || ' ' || p_partkey AS title, CAST(1970 + p_size AS INTEGER) AS year,
             CAST(ascii(p_type) * 1000 + length(p_type) AS BIGINT) AS franchise_id,
             CASE WHEN p_partkey % 3 = 0 THEN 'game' WHEN p_partkey % 10 = 7 THEN 'soundtrack' ELSE 'film' END AS media_type
           FROM part""",
    ),
    "films": (
        [],
        """SELECT p_partkey AS id, p_partkey AS media_id, CAST(substr(p_brand, 7) AS BIGINT) AS studio_id,
             CASE WHEN p_size % 5 = 0 THEN 'hybrid' ELSE 'fully_animated' END AS animation_type
           FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 10 <> 7""",
    ),
    "studios": (
        [],
        """SELECT id, name, CAST(1900 + id AS INTEGER) AS years_active_start,
             CASE WHEN id % 2 = 1 THEN CAST(1990 + id AS INTEGER) END AS years_active_end,
             CASE WHEN id % 2 = 1 THEN 'closed' ELSE 'active' END AS status
           FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS id, p_brand AS name FROM part)""",
    ),
    "franchises": (
        [],
        """SELECT CAST(ascii(p_type) * 1000 + length(p_type) AS BIGINT) AS id, p_type AS name,
             min(CAST(substr(p_brand, 7) AS BIGINT)) AS studio_id
           FROM part GROUP BY p_type""",
    ),
    "games": (
        [],
        """SELECT p_partkey AS id, p_partkey AS media_id, p_type AS developer, p_brand AS publisher, p_size % 3 AS device
           FROM part WHERE p_partkey % 3 = 0""",
    ),
    "game_platforms": (
        ["games", "platforms"],
        """SELECT g.id AS game_id, p.id AS platform_id FROM games g
           JOIN (VALUES (0, 'PlayStation 2'), (0, 'Xbox 360'), (1, 'PC'), (2, 'Nintendo DS'), (2, 'Nintendo Wii'))
             AS d(device, name) ON g.device = d.device
           JOIN platforms p ON p.name = d.name""",
    ),
    "game_sales": (
        [],
        """SELECT l_partkey AS game_id, CAST(l_quantity AS BIGINT) AS units_sold,
             CAST(l_extendedprice AS DECIMAL(14,2)) AS revenue
           FROM lineitem WHERE l_partkey % 3 = 0""",
    ),
    "talent": ([], "SELECT s_suppkey AS id, s_name AS name FROM supplier"),
    "characters": (
        [],
        """SELECT c_custkey AS id, c_name AS name, p_type AS franchise,
             CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 14 + 1 END AS role_id,
             CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey % 3 + 1 AS BIGINT) END AS gender_id,
             CASE WHEN c_nationkey <> 24 THEN n_name END AS species,
             CAST(1970 + p_size AS INTEGER) AS first_appearance_year, CAST(substr(p_brand, 7) AS BIGINT) AS studio_id,
             CASE WHEN c_nationkey % 6 = 1 THEN CAST(c_nationkey % 5 + 1 AS BIGINT) END AS species_id,
             CASE WHEN c_custkey % 7 = 0 THEN 'form ' || (c_custkey % 3) END AS species_subtype, c_custkey % 4 = 0 AS is_anthropomorphic
           FROM customer LEFT JOIN part ON p_partkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "appearance_rows": (
        [],
        """SELECT o_custkey AS character_id, l_partkey AS media_id, l_suppkey AS talent_id,
             CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 5 ELSE 4 END AS BIGINT) AS role_id, l_linestatus AS notes
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    ),
    "appearances": (
        ["appearance_rows"],
        """SELECT character_id, media_id, talent_id, role_id, notes FROM (
             SELECT *, row_number() OVER (PARTITION BY character_id, media_id ORDER BY talent_id, role_id, notes) AS rn
             FROM appearance_rows) WHERE rn = 1""",
    ),
    "dashboard_films": (
        ["films", "media"],
        "SELECT 'film-' || f.id AS id, m.title, m.year, f.studio_id FROM films f JOIN media m ON m.id = f.media_id",
    ),
    "dashboard_characters": (
        ["characters", "roles", "genders"],
        """SELECT c.id, c.name, r.name AS role, g.name AS gender, c.species, c.franchise, c.studio_id,
             CASE WHEN c.id % 11 = 0 THEN 'N/A'
                  WHEN c.id % 5 <> 0 THEN 'Actor ' || (c.id % 89) || ', Second Name (guest)' END AS voice_actor,
             '["film-' || c.id || '","film-' || (c.id * 2 + 1) || '"]' AS film_ids
           FROM characters c LEFT JOIN roles r ON r.id = c.role_id LEFT JOIN genders g ON g.id = c.gender_id""",
    ),
    "cast_films": (
        ["dashboard_characters"],
        """SELECT *, 'film-' || id AS film_id FROM dashboard_characters
           UNION ALL SELECT *, 'film-' || (id * 2 + 1) AS film_id FROM dashboard_characters""",
    ),
    "reports": (
        [],
        """SELECT l_partkey AS film_id, CAST(l_shipdate AS DATE) AS report_date, n_name AS state_code,
             CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue
           FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    ),
    "daily": (
        ["reports", "media"],
        """SELECT r.*, m.title AS film_title, m.year AS film_year, date_diff('day', f.release, report_date) AS days,
             CAST(date_diff('day', f.release, report_date) // 7 + 1 AS INTEGER) AS week_number,
             isodow(report_date) >= 5 AS is_weekend
           FROM reports r
           JOIN (SELECT film_id, min(report_date) AS release FROM reports GROUP BY film_id) f ON f.film_id = r.film_id
           JOIN media m ON m.id = r.film_id""",
    ),
    "weekly_base": (
        ["daily"],
        """SELECT film_id, film_title, film_year, week_number, sum(revenue) AS total_revenue,
             CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_daily_revenue, count(*) AS days_reporting,
             count(DISTINCT report_date) AS distinct_days,
             coalesce(sum(revenue) FILTER (WHERE is_weekend), 0) AS weekend_revenue,
             coalesce(sum(revenue) FILTER (WHERE NOT is_weekend), 0) AS weekday_revenue,
             count(DISTINCT state_code) AS states_reporting
           FROM daily GROUP BY ALL""",
    ),
    "weekly": (
        ["weekly_base"],
        """SELECT *, CASE WHEN prev_week_revenue > 0 THEN
             CAST(total_revenue - prev_week_revenue AS DOUBLE) / CAST(prev_week_revenue AS DOUBLE) END AS wow_change
           FROM (SELECT *, lag(total_revenue) OVER (PARTITION BY film_id ORDER BY week_number) AS prev_week_revenue
                 FROM weekly_base)""",
    ),
    "total": (
        ["daily"],
        """SELECT film_id, film_title, film_year, sum(revenue) AS total_revenue, min(report_date) AS first_report_date,
             max(report_date) AS last_report_date, max(week_number) AS weeks_in_release,
             count(DISTINCT report_date) AS days_in_release, count(DISTINCT state_code) AS states_reached,
             sum(revenue) FILTER (WHERE week_number = 1) AS opening_week_revenue,
             CAST(sum(revenue) AS DOUBLE) / count(DISTINCT report_date) AS avg_daily_revenue
           FROM daily GROUP BY film_id, film_title, film_year""",
    ),
    "film_revenue": (
        ["films", "media", "total"],
        """SELECT f.id AS film_id, f.media_id, f.studio_id, f.animation_type, m.title, m.year, t.total_revenue,
             t.opening_week_revenue, t.weeks_in_release
           FROM films f JOIN media m ON m.id = f.media_id LEFT JOIN total t ON t.film_id = f.id""",
    ),
    "soundtracks": (
        [],
        """SELECT p_partkey AS id, p_partkey AS media_id, p_partkey - 1 AS source_media_id, p_brand AS label
           FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 10 = 7""",
    ),
    "album_lines": ([], "SELECT * FROM lineitem WHERE l_partkey % 3 <> 0 AND l_partkey % 10 = 7"),
    "songs": (
        ["album_lines"],
        """SELECT DISTINCT l_partkey * 100 + l_linenumber AS id, l_partkey AS soundtrack_id,
             'Song ' || l_linenumber AS title, l_linenumber AS track_number
           FROM album_lines""",
    ),
    "song_credits": (
        ["album_lines"],
        """SELECT DISTINCT l_partkey * 100 + l_linenumber AS song_id, l_suppkey AS talent_id,
             CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS credit_type_id
           FROM album_lines""",
    ),
    "nominations": (
        [],
        """SELECT o_orderkey AS id, o_custkey AS media_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS award_category_id,
             CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderstatus = 'F' THEN 'won' ELSE 'nominated' END AS outcome,
             o_custkey AS talent_id, o_custkey * 100 + 1 AS song_id
           FROM orders""",
    ),
    "event_reports": (
        [],
        """SELECT user_id AS film_id, CAST(ts AS DATE) AS report_date, event_type AS state_code,
             CAST(value AS DECIMAL(14,2)) AS revenue, event_id, ts FROM events""",
    ),
}


def with_views(body: str, *names: str) -> str:
    """The SQL text with the views it reads (and theirs) in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in VIEWS[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + "\n" + body
