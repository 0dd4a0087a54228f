"""Facts, revenue, people, views, marts and insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelweave import fixed_values as fv
from reelweave.operators import relational as rel
from reelweave.plans import boxoffice as bo
from reelweave.plans import insights, marts, people, views
from reelweave.plans.partners import top_partners
from reelweave.registry import query
from reelweave.registry.catalogue import with_views

# ---------------------------------------------------------------- box-office facts


@query("box_office_daily", with_views(
    """SELECT film_id, film_title, film_year, report_date, state_code, CAST(revenue AS DOUBLE) AS revenue,
         CAST(days AS INTEGER) AS days_since_release, week_number, is_weekend FROM daily""", "daily"))
def _(t):
    return t.box_office_daily.select(
        "film_id", "film_title", "film_year", "report_date", "state_code", "revenue", "days_since_release",
        "week_number", "is_weekend")


@query("box_office_daily_matched", with_views(
    """SELECT CASE WHEN f.id IS NOT NULL THEN e.film_id END AS film_id, m.title AS film_title, m.year AS film_year,
         report_date, state_code, CAST(revenue AS DOUBLE) AS revenue, isodow(report_date) >= 5 AS is_weekend
       FROM event_reports e JOIN media m ON m.id = e.film_id LEFT JOIN films f ON f.id = e.film_id""",
    "event_reports", "media", "films"))
def _(t):
    titles = t.media.select(F.col("id").alias("film_id"), F.col("title").alias("film_title"), F.col("year").alias("film_year"))
    raw = t.event_reports().join(titles, "film_id").select(
        "film_title", "film_year", F.col("report_date").cast("string").alias("report_date"), "state_code", "revenue",
        F.lit(1).alias("week_number"), (F.weekday("report_date") >= 4).alias("is_weekend"))
    return bo.build_daily(raw, t.films, t.media).drop("id", "week_number")


@query("box_office_weekly", with_views(
    """SELECT film_id, film_title, film_year, week_number, CAST(total_revenue AS DOUBLE) AS total_revenue,
         avg_daily_revenue, days_reporting, distinct_days, CAST(weekend_revenue AS DOUBLE) AS weekend_revenue,
         CAST(weekday_revenue AS DOUBLE) AS weekday_revenue, states_reporting,
         CAST(prev_week_revenue AS DOUBLE) AS prev_week_revenue, wow_change FROM weekly""", "weekly"))
def _(t):
    return t.box_office_weekly.drop("id")


TOTAL_COLUMNS = """film_id, film_title, film_year, CAST(total_revenue AS DOUBLE) AS total_revenue, first_report_date,
  last_report_date, weeks_in_release, days_in_release, states_reached,
  CAST(opening_week_revenue AS DOUBLE) AS opening_week_revenue, avg_daily_revenue"""


@query("box_office_total", with_views(f"SELECT {TOTAL_COLUMNS} FROM total", "total"))
def _(t):
    return t.box_office_total.drop("id")


@query("weighted_allocation", with_views(
    "SELECT t.film_id, w.state_code, round(CAST(t.total_revenue AS DOUBLE) * w.weight, 2) AS revenue FROM total t, (VALUES "
    + ", ".join(f"('{s}', {w}::DOUBLE)" for s, w in fv.STATE_WEIGHTS.items())
    + ") AS w(state_code, weight) WHERE CAST(t.total_revenue AS DOUBLE) * w.weight >= 100", "total"))
def _(t):
    return bo.allocate(t.box_office_total.select("film_id", "total_revenue"), "total_revenue").drop("total_revenue")


# ---------------------------------------------------------------- revenue queries


@query("revenue_by_studio", with_views(
    """SELECT s.name AS studio_name, s.status AS studio_status, count(DISTINCT film_id) AS film_count,
         CAST(sum(total_revenue) AS DOUBLE) AS total_box_office,
         CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_box_office_per_film,
         CAST(max(total_revenue) AS DOUBLE) AS highest_grossing, CAST(min(total_revenue) AS DOUBLE) AS lowest_grossing,
         CAST(sum(opening_week_revenue) AS DOUBLE) AS total_opening_weekend,
         CAST(sum(opening_week_revenue) AS DOUBLE) / count(opening_week_revenue) AS avg_opening_weekend
       FROM film_revenue f JOIN studios s ON s.id = f.studio_id GROUP BY s.name, s.status""", "film_revenue", "studios"))
def _(t):
    return bo.revenue_by_studio(t)


@query("revenue_by_studio_year", with_views(
    """SELECT s.name AS studio_name, f.year, count(DISTINCT film_id) AS films_released,
         CAST(sum(total_revenue) AS DOUBLE) AS annual_revenue,
         CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_revenue_per_film
       FROM film_revenue f JOIN studios s ON s.id = f.studio_id GROUP BY s.name, f.year""", "film_revenue", "studios"))
def _(t):
    return bo.revenue_by_studio_year(t)


@query("top_films_per_studio", with_views(
    """SELECT s.name AS studio_name, f.title, f.year, CAST(total_revenue AS DOUBLE) AS total_revenue,
         CAST(opening_week_revenue AS DOUBLE) AS opening_week_revenue, weeks_in_release,
         CAST(rank() OVER (PARTITION BY s.name ORDER BY total_revenue DESC) AS INTEGER) AS studio_rank
       FROM film_revenue f JOIN studios s ON s.id = f.studio_id WHERE total_revenue IS NOT NULL
       QUALIFY studio_rank <= 10""", "film_revenue", "studios"))
def _(t):
    return bo.top_films_per_studio(t)


@query("revenue_by_animation", with_views(
    """SELECT animation_type, count(*) AS films, CAST(sum(total_revenue) AS DOUBLE) AS total_revenue
       FROM films f LEFT JOIN total t ON t.film_id = f.id GROUP BY animation_type""", "films", "total"))
def _(t):
    return bo.revenue_by_animation(t)


@query("weekly_decay", with_views(
    """SELECT week_number, count(*) AS films_in_week, CAST(sum(total_revenue) AS DOUBLE) / count(*) AS avg_weekly_revenue,
         round(avg(wow_change), 6) AS avg_week_over_week_change, min(wow_change) AS worst_drop, max(wow_change) AS best_hold
       FROM weekly WHERE week_number <= 12 GROUP BY week_number""", "weekly"))
def _(t):
    return bo.weekly_decay(t).withColumn("avg_week_over_week_change", F.round("avg_week_over_week_change", 6))


@query("weekend_split", with_views(
    """SELECT s.name AS studio_name, CAST(sum(revenue) FILTER (WHERE is_weekend) AS DOUBLE) AS total_weekend_revenue,
         CAST(sum(revenue) FILTER (WHERE NOT is_weekend) AS DOUBLE) AS total_weekday_revenue,
         round(100.0::DOUBLE * CAST(sum(revenue) FILTER (WHERE is_weekend) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 2)
           AS weekend_percentage
       FROM daily d JOIN films f ON f.id = d.film_id JOIN studios s ON s.id = f.studio_id GROUP BY s.name""",
    "daily", "films", "studios"))
def _(t):
    return bo.weekend_split(t)


@query("geographic_share", with_views(
    """SELECT state_code, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(DISTINCT film_id) AS films_shown,
         CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_daily_revenue,
         round(100.0::DOUBLE * CAST(sum(revenue) AS DOUBLE) / CAST(sum(sum(revenue)) OVER () AS DOUBLE), 2) AS market_share
       FROM reports GROUP BY state_code""", "reports"))
def _(t):
    t.box_office_daily = t.box_office_reports()
    return bo.geographic_share(t)


@query("opening_performance", with_views(
    """SELECT s.name AS studio_name, f.title, f.year, CAST(opening_week_revenue AS DOUBLE) AS opening_week_revenue,
         CAST(total_revenue AS DOUBLE) AS total_revenue,
         round(100.0::DOUBLE * CAST(opening_week_revenue AS DOUBLE) / CAST(total_revenue AS DOUBLE), 2) AS opening_pct_of_total,
         weeks_in_release
       FROM film_revenue f JOIN studios s ON s.id = f.studio_id WHERE opening_week_revenue IS NOT NULL
       ORDER BY f.opening_week_revenue DESC, film_id LIMIT 25""", "film_revenue", "studios"))
def _(t):
    return bo.opening_performance(t)


@query("long_runners", with_views(
    """SELECT f.title, f.year, s.name AS studio_name, weeks_in_release, CAST(total_revenue AS DOUBLE) AS total_revenue,
         CAST(opening_week_revenue AS DOUBLE) AS opening_week_revenue,
         round(CAST(total_revenue AS DOUBLE) / CAST(opening_week_revenue AS DOUBLE), 2) AS total_to_opening_ratio
       FROM film_revenue f JOIN studios s ON s.id = f.studio_id WHERE weeks_in_release >= 10
       ORDER BY f.weeks_in_release DESC, f.total_revenue DESC, film_id LIMIT 20""", "film_revenue", "studios"))
def _(t):
    return bo.long_runners(t)


@query("yearly_trend", with_views(
    """SELECT film_year AS year, count(DISTINCT film_id) AS films, CAST(sum(total_revenue) AS DOUBLE) AS total_annual_revenue,
         CAST(sum(total_revenue) AS DOUBLE) / count(*) AS avg_film_revenue,
         CAST(max(total_revenue) AS DOUBLE) AS top_film_revenue
       FROM total WHERE film_year IS NOT NULL GROUP BY film_year""", "total"))
def _(t):
    return bo.yearly_trend(t)


# ---------------------------------------------------------------- people


@query("franchise_demographics", with_views(
    """SELECT c.franchise, count(*) AS total_characters, count(DISTINCT species) AS unique_species,
         CAST(count(*) FILTER (WHERE g.name = 'male') AS BIGINT) AS male_count,
         CAST(count(*) FILTER (WHERE g.name = 'female') AS BIGINT) AS female_count,
         CAST(count(*) FILTER (WHERE g.name = 'non-binary') AS BIGINT) AS nonbinary_count,
         count(*) FILTER (WHERE r.name IN ('protagonist', 'deuteragonist', 'hero')) AS hero_count,
         count(*) FILTER (WHERE r.name IN ('villain', 'antagonist')) AS villain_count
       FROM characters c LEFT JOIN genders g ON g.id = c.gender_id LEFT JOIN roles r ON r.id = c.role_id
       GROUP BY c.franchise""", "characters", "genders", "roles"))
def _(t):
    return people.franchise_demographics(t)


@query("studio_characters", with_views(
    """SELECT s.name AS studio_name, count(*) AS total_characters, count(DISTINCT franchise) AS franchises,
         count(DISTINCT species) AS unique_species, round(CAST(sum(n) AS DOUBLE) / count(*), 2) AS avg_appearances_per_char
       FROM (SELECT studio_id, character_id, count(*) AS n FROM appearances a JOIN films f ON f.media_id = a.media_id
             GROUP BY studio_id, character_id) p
       JOIN characters c ON c.id = p.character_id JOIN studios s ON s.id = p.studio_id GROUP BY s.name""",
    "appearances", "films", "characters", "studios"))
def _(t):
    return people.studio_characters(t)


@query("species_share", with_views(
    """SELECT species, count(*) AS character_count, count(DISTINCT franchise) AS franchises_appeared,
         round(100.0::DOUBLE * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS percentage
       FROM characters WHERE species IS NOT NULL GROUP BY species ORDER BY count(*) DESC, species LIMIT 20""", "characters"))
def _(t):
    return people.species_share(t)


@query("gender_by_release_year", with_views(
    """SELECT m.year, g.name AS gender, count(*) AS character_count FROM appearances a
       JOIN characters c ON c.id = a.character_id JOIN genders g ON g.id = c.gender_id JOIN media m ON m.id = a.media_id
       WHERE m.year IS NOT NULL GROUP BY m.year, g.name""", "appearances", "characters", "genders", "media"))
def _(t):
    return people.gender_by_release_year(t)


@query("role_by_gender", with_views(
    """SELECT r.name AS role, g.name AS gender, count(*) AS character_count FROM characters c
       JOIN roles r ON r.id = c.role_id JOIN genders g ON g.id = c.gender_id GROUP BY r.name, g.name""",
    "characters", "roles", "genders"))
def _(t):
    return people.role_by_gender(t)


@query("actor_careers", with_views(
    """SELECT t.name AS voice_actor, count(*) AS total_appearances, count(DISTINCT a.character_id) AS unique_characters,
         count(DISTINCT m.id) AS films_appeared, count(DISTINCT c.franchise) AS franchises,
         min(m.year) AS first_appearance, max(m.year) AS last_appearance, max(m.year) - min(m.year) AS career_span_years
       FROM talent t JOIN appearances a ON a.talent_id = t.id JOIN characters c ON c.id = a.character_id
       JOIN media m ON m.id = a.media_id GROUP BY t.name HAVING count(*) >= 3
       ORDER BY count(*) DESC, t.name LIMIT 50""", "talent", "appearances", "characters", "media"))
def _(t):
    return people.actor_careers(t)


@query("actor_box_office", with_views(
    """SELECT t.name AS voice_actor, count(*) AS appearances, CAST(sum(total_revenue) AS DOUBLE) AS total_box_office,
         CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_box_office_per_film,
         CAST(max(total_revenue) AS DOUBLE) AS highest_grossing_film
       FROM talent t JOIN appearances a ON a.talent_id = t.id JOIN film_revenue f ON f.media_id = a.media_id
       GROUP BY t.name HAVING sum(total_revenue) IS NOT NULL ORDER BY sum(f.total_revenue) DESC, t.name LIMIT 30""",
    "talent", "appearances", "film_revenue"))
def _(t):
    return people.actor_box_office(t).withColumn("appearances", F.col("appearances").cast("bigint"))


ACTOR_STUDIO = """SELECT t.name AS voice_actor, s.name AS studio_name, count(*) AS appearances_at_studio
  FROM talent t JOIN appearances a ON a.talent_id = t.id JOIN films f ON f.media_id = a.media_id
  JOIN studios s ON s.id = f.studio_id GROUP BY t.name, s.name"""


@query("actor_studio_share", with_views(
    f"""SELECT *, round(100.0::DOUBLE * appearances_at_studio /
         CAST(sum(appearances_at_studio) OVER (PARTITION BY voice_actor) AS DOUBLE), 2) AS pct_of_career
       FROM ({ACTOR_STUDIO} HAVING count(*) >= 2)""", "talent", "appearances", "films", "studios"))
def _(t):
    return people.actor_studio_share(t)


@query("exclusive_actors", with_views(
    f"""SELECT studio_name, count(*) FILTER (WHERE share >= 5) AS loyal_actors,
         count(*) FILTER (WHERE share = 100) AS exclusive_actors
       FROM (SELECT *, 100.0::DOUBLE * appearances_at_studio /
               CAST(sum(appearances_at_studio) OVER (PARTITION BY voice_actor) AS DOUBLE) AS share FROM ({ACTOR_STUDIO}))
       WHERE appearances_at_studio >= 2 GROUP BY studio_name""", "talent", "appearances", "films", "studios"))
def _(t):
    return people.exclusive_actors(t, loyal_share=5.0)


@query("hero_actors", with_views(
    """SELECT t.name AS voice_actor, r.name AS role_type, count(*) AS role_count, count(DISTINCT c.franchise) AS franchises
       FROM talent t JOIN appearances a ON a.talent_id = t.id JOIN characters c ON c.id = a.character_id
       JOIN roles r ON r.id = a.role_id WHERE r.name IN ('protagonist', 'deuteragonist', 'hero')
       GROUP BY t.name, r.name HAVING count(*) >= 2 ORDER BY count(*) DESC, t.name, r.name LIMIT 20""",
    "talent", "appearances", "characters", "roles"))
def _(t):
    return people.hero_actors(t)


BY_MEDIUM = """SELECT {who} AS who, nullif(count(*) FILTER (WHERE media_type = 'film'), 0) AS film_appearances,
    nullif(count(*) FILTER (WHERE media_type = 'game'), 0) AS game_appearances, count(*) AS total_appearances
  FROM appearances a JOIN media m ON m.id = a.media_id GROUP BY {who}"""


@query("cross_media_actors", with_views(
    f"""SELECT t.name AS voice_actor, film_appearances, game_appearances, total_appearances
       FROM ({BY_MEDIUM.format(who='talent_id')}) b JOIN talent t ON t.id = b.who
       WHERE film_appearances > 0 AND game_appearances > 0""", "appearances", "media", "talent"))
def _(t):
    return people.cross_media_actors(t)


@query("cross_media_characters", with_views(
    f"""SELECT who AS character_id, c.name AS character_name, c.franchise, film_appearances, game_appearances, total_appearances
       FROM ({BY_MEDIUM.format(who='character_id')}) b JOIN characters c ON c.id = b.who
       WHERE film_appearances > 0 AND game_appearances > 0""", "appearances", "media", "characters"))
def _(t):
    return people.cross_media_characters(t)


@query("most_appearances", with_views(
    f"""SELECT who AS character_id, c.name AS character_name, film_appearances, game_appearances, total_appearances
       FROM ({BY_MEDIUM.format(who='character_id')} ORDER BY count(*) DESC, character_id LIMIT 10) b
       JOIN characters c ON c.id = b.who""", "appearances", "media", "characters"))
def _(t):
    return people.most_appearances(t)


@query("top_characters", with_views(
    """SELECT c.name, c.franchise, count(*) AS appearances FROM appearances a JOIN characters c ON c.id = a.character_id
       GROUP BY c.name, c.franchise ORDER BY count(*) DESC, c.name, c.franchise LIMIT 20""", "appearances", "characters"))
def _(t):
    return people.top_characters(t)


@query("studio_film_counts", with_views(
    """SELECT name, status, (SELECT count(*) FROM films f WHERE f.studio_id = s.id) AS film_count FROM studios s""",
    "films", "studios"))
def _(t):
    return people.studio_film_counts(t)


# ---------------------------------------------------------------- dashboard aggregates

SPLIT = """count(*) FILTER (WHERE gender = 'male') AS male, count(*) FILTER (WHERE gender = 'female') AS female,
  count(*) FILTER (WHERE gender IS NULL OR gender NOT IN ('male', 'female')) AS other"""


@query("dashboard_gender_by_year", with_views(
    f"""SELECT f.year, {SPLIT}, count(*) AS total FROM cast_films c JOIN dashboard_films f ON f.id = c.film_id
       WHERE f.year > 0 GROUP BY f.year""", "cast_films", "dashboard_films"))
def _(t):
    return people.dashboard_gender_by_year(t.dashboard_characters, t.dashboard_films)


@query("dashboard_gender_by_role", with_views(
    f"SELECT role, {SPLIT} FROM dashboard_characters GROUP BY role", "dashboard_characters"))
def _(t):
    return people.dashboard_gender_by_role(t.dashboard_characters)


@query("top_talents", with_views(
    """SELECT voice_actor AS name, 2 * count(*) AS film_count, count(*) AS character_count,
         array_to_string(list_sort(list(DISTINCT CAST(studio_id AS VARCHAR)) FILTER (WHERE studio_id IS NOT NULL)), ', ') AS studios
       FROM dashboard_characters WHERE voice_actor IS NOT NULL AND lower(voice_actor) <> 'n/a'
       GROUP BY voice_actor ORDER BY count(*) DESC, voice_actor LIMIT 50""", "dashboard_characters"))
def _(t):
    characters = t.dashboard_characters.withColumn("studio_id", F.col("studio_id").cast("string"))
    return people.top_talents(characters)


@query("prolific_actors", with_views(
    """SELECT trim(split_part(split_part(voice_actor, ',', 1), '(', 1)) AS name, count(*) AS characters
       FROM dashboard_characters WHERE voice_actor IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""", "dashboard_characters"))
def _(t):
    return people.prolific_actors(t.dashboard_characters)


@query("role_breakdown", with_views(
    "SELECT role, count(*) AS count FROM dashboard_characters WHERE studio_id = 7 GROUP BY role", "dashboard_characters"))
def _(t):
    return people.breakdown(t.dashboard_characters, "role", {"studio_id": 7})


@query("species_breakdown", with_views(
    """SELECT species, count(*) AS count FROM dashboard_characters WHERE studio_id = 7 GROUP BY species
       ORDER BY 2 DESC, 1 NULLS LAST LIMIT 20""", "dashboard_characters"))
def _(t):
    return people.breakdown(t.dashboard_characters, "species", {"studio_id": 7}, 20)


@query("film_gender_breakdown", with_views(
    """SELECT gender, count(*) AS count FROM cast_films WHERE film_id = 'film-101' GROUP BY gender""", "cast_films"))
def _(t):
    return people.film_gender_breakdown(t.dashboard_characters, "film-101")


@query("voice_actors_per_film", with_views(
    """SELECT film_id, count(DISTINCT voice_actor) AS voice_actors FROM cast_films WHERE voice_actor IS NOT NULL
       GROUP BY film_id""", "cast_films"))
def _(t):
    return people.voice_actors_per_film(t.dashboard_characters)


@query("films_by_year", with_views(
    "SELECT year, count(*) AS count FROM dashboard_films GROUP BY year", "dashboard_films"))
def _(t):
    return people.films_by_year(t.dashboard_films)


@query("species_group_share", """
SELECT species, count(*) AS count, round(100.0::DOUBLE * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 0) AS percentage
FROM (SELECT CASE WHEN contains(t, 'human') THEN 'Human' WHEN contains(t, 'toy') THEN 'Toy'
        WHEN contains(t, 'animal') OR contains(t, 'dog') OR contains(t, 'cat') OR contains(t, 'lion')
          OR contains(t, 'fish') OR contains(t, 'bird') THEN 'Animal'
        WHEN contains(t, 'monster') THEN 'Monster' WHEN contains(t, 'robot') OR contains(t, 'machine') THEN 'Robot'
        WHEN contains(t, 'fairy') OR contains(t, 'magic') THEN 'Magical' WHEN contains(t, 'heartless') THEN 'Heartless'
        WHEN contains(t, 'nobody') THEN 'Nobody' ELSE 'Other' END AS species
      FROM (SELECT lower(text) AS t FROM documents))
GROUP BY species ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return people.species_group_share(t.raw("documents").select(F.col("text").alias("species")))


@query("villain_share", with_views(
    """SELECT category, count, CAST(round(100.0::DOUBLE * count / nullif(total, 0), 0) AS DOUBLE) AS percentage
       FROM (SELECT count(*) AS total, count(*) FILTER (WHERE gender = 'male') AS m,
               count(*) FILTER (WHERE gender = 'female') AS f
             FROM dashboard_characters WHERE role IN ('villain', 'antagonist')) v,
         LATERAL (VALUES ('Male Villains', m), ('Female Villains', f), ('Non-binary/Other', total - m - f)) AS x(category, count)""",
    "dashboard_characters"))
def _(t):
    return people.villain_share(t.dashboard_characters)


@query("role_balance", with_views(
    """SELECT studio_id, count(*) FILTER (WHERE role IN ('protagonist', 'deuteragonist', 'hero')) AS protagonists,
         count(*) FILTER (WHERE role IN ('villain', 'antagonist')) AS antagonists,
         count(*) FILTER (WHERE role IN ('sidekick', 'ally')) AS sidekicks
       FROM dashboard_characters GROUP BY studio_id""", "dashboard_characters"))
def _(t):
    return people.role_balance(t.dashboard_characters)


@query("studios_by_characters", with_views(
    """SELECT s.name, count(c.id) AS char_count FROM studios s LEFT JOIN characters c ON c.studio_id = s.id
       GROUP BY s.name ORDER BY 2 DESC, 1 LIMIT 5""", "studios", "characters"))
def _(t):
    return people.studios_by_characters(t.studios, t.characters)


@query("grand_totals", with_views(
    """SELECT CAST((SELECT count(*) FROM films) AS BIGINT) AS films,
         CAST((SELECT count(*) FROM characters) AS BIGINT) AS characters""", "films", "characters"))
def _(t):
    return insights.grand_totals(t.films, t.characters)


# ---------------------------------------------------------------- views


@query("v_media", with_views(
    """SELECT m.id, title, year, media_type, f.name AS franchise_name FROM media m JOIN franchises f ON f.id = m.franchise_id""",
    "media", "franchises"))
def _(t):
    return views.v_media(t)


@query("v_media_all", with_views(
    """SELECT m.id, title, year, media_type, f.name AS franchise_name FROM media m
       LEFT JOIN (SELECT * FROM franchises WHERE name <> 'PROMO') f ON f.id = m.franchise_id""", "media", "franchises"))
def _(t):
    t.franchises = t.franchises.filter("name <> 'PROMO'")
    return views.v_media(t, keep_without_franchise=True)


@query("v_films", with_views(
    """SELECT f.id AS film_id, f.media_id, m.title, m.year, s.name AS studio_name, fr.name AS franchise_name, animation_type
       FROM films f JOIN media m ON m.id = f.media_id JOIN studios s ON s.id = f.studio_id
       JOIN franchises fr ON fr.id = m.franchise_id""", "films", "media", "studios", "franchises"))
def _(t):
    return views.v_films(t)


@query("v_games", with_views(
    """SELECT g.id AS game_id, g.media_id, m.title, m.year, fr.name AS franchise_name, g.developer, g.publisher,
         string_agg(DISTINCT p.name, ', ' ORDER BY p.name) AS platforms
       FROM games g JOIN media m ON m.id = g.media_id JOIN franchises fr ON fr.id = m.franchise_id
       LEFT JOIN game_platforms gp ON gp.game_id = g.id LEFT JOIN platforms p ON p.id = gp.platform_id GROUP BY ALL""",
    "games", "media", "franchises", "game_platforms", "platforms"))
def _(t):
    return views.v_games(t)


@query("v_soundtracks", with_views(
    """SELECT st.id AS soundtrack_id, st.media_id, m.title, m.year, fr.name AS franchise_name, st.label,
         src.title AS source_title, src.media_type AS source_type
       FROM soundtracks st JOIN media m ON m.id = st.media_id JOIN franchises fr ON fr.id = m.franchise_id
       LEFT JOIN media src ON src.id = st.source_media_id""", "soundtracks", "media", "franchises"))
def _(t):
    return views.v_soundtracks(t)


@query("v_songs", with_views(
    """SELECT s.id AS song_id, s.title AS song_title, s.track_number, st.id AS soundtrack_id, m.title AS soundtrack_title,
         m.year, c.credits
       FROM songs s JOIN soundtracks st ON st.id = s.soundtrack_id JOIN media m ON m.id = st.media_id
       LEFT JOIN (SELECT song_id, string_agg(DISTINCT t.name || ' (' || ct.name || ')', ', ' ORDER BY t.name || ' (' || ct.name || ')') AS credits
                  FROM song_credits sc JOIN talent t ON t.id = sc.talent_id JOIN credit_types ct ON ct.id = sc.credit_type_id
                  GROUP BY song_id) c ON c.song_id = s.id""",
    "songs", "soundtracks", "media", "song_credits", "talent", "credit_types"))
def _(t):
    return views.v_songs(t)


@query("v_character_appearances", with_views(
    """SELECT a.character_id, a.media_id, c.name AS character_name, c.franchise AS origin_franchise,
         coalesce(['human', 'toy', 'monster', 'robot', 'emotion'][c.species_id], c.species) AS species, c.species_subtype, c.is_anthropomorphic,
         g.name AS gender, m.title AS media_title, m.year AS media_year, m.media_type, t.name AS voice_actor, r.name AS role,
         CAST(NULL AS VARCHAR) AS variant, a.notes
       FROM appearances a JOIN characters c ON c.id = a.character_id JOIN media m ON m.id = a.media_id
       JOIN roles r ON r.id = a.role_id LEFT JOIN genders g ON g.id = c.gender_id LEFT JOIN talent t ON t.id = a.talent_id""",
    "appearances", "characters", "media", "roles", "genders", "talent"))
def _(t):
    return views.v_character_appearances(t).drop("id")


@query("v_box_office_by_film", with_views(
    """SELECT f.id AS film_id, m.title, m.year, CAST(sum(revenue) AS DOUBLE) AS total_gross, min(report_date) AS release_date,
         max(report_date) AS last_date, max(week_number) AS weeks_in_release
       FROM films f JOIN media m ON m.id = f.media_id JOIN daily d ON d.film_id = f.id GROUP BY f.id, m.title, m.year""",
    "films", "media", "daily"))
def _(t):
    return views.v_box_office_by_film(t)


@query("v_game_sales_by_game", with_views(
    """SELECT g.id AS game_id, m.title, m.year, CAST(sum(units_sold) AS BIGINT) AS total_units,
         CAST(sum(revenue) AS DOUBLE) AS total_revenue
       FROM games g JOIN media m ON m.id = g.media_id JOIN game_sales gs ON gs.game_id = g.id GROUP BY g.id, m.title, m.year""",
    "games", "media", "game_sales"))
def _(t):
    return views.v_game_sales_by_game(t)


@query("v_nominations", with_views(
    """SELECT n.id, m.title AS media_title, m.year AS media_year, m.media_type, ab.name AS award_body, ac.name AS category,
         ac.is_media_level, n.year AS ceremony_year, n.outcome, t.name AS talent_name, s.title AS song_title
       FROM nominations n JOIN media m ON m.id = n.media_id JOIN award_categories ac ON ac.id = n.award_category_id
       JOIN award_bodies ab ON ab.id = ac.award_body_id LEFT JOIN talent t ON t.id = n.talent_id
       LEFT JOIN songs s ON s.id = n.song_id""",
    "nominations", "media", "award_categories", "award_bodies", "talent", "songs"))
def _(t):
    return views.v_nominations(t)


@query("v_media_awards", with_views(
    """SELECT m.id AS media_id, m.title, m.year, m.media_type,
         count(*) FILTER (WHERE n.outcome = 'nominated') AS total_nominations,
         count(*) FILTER (WHERE n.outcome = 'won') AS total_wins, count(n.id) AS total_entries
       FROM media m LEFT JOIN nominations n ON n.media_id = m.id GROUP BY m.id, m.title, m.year, m.media_type""",
    "media", "nominations"))
def _(t):
    return views.v_media_awards(t)


@query("v_characters", with_views(
    """SELECT c.id, c.name, c.species, g.name AS gender, r.name AS role, c.franchise, s.name AS studio_name
       FROM characters c LEFT JOIN genders g ON g.id = c.gender_id LEFT JOIN roles r ON r.id = c.role_id
       LEFT JOIN studios s ON s.id = c.studio_id""", "characters", "genders", "roles", "studios"))
def _(t):
    return views.v_characters(t)


@query("v_gender_stats", with_views(
    """SELECT g.name AS gender, count(*) AS character_count,
         round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM characters), 2) AS percentage
       FROM characters c LEFT JOIN genders g ON g.id = c.gender_id GROUP BY g.name""", "characters", "genders"))
def _(t):
    return views.v_gender_stats(t)


@query("v_role_stats", with_views(
    """SELECT r.name AS role, count(*) AS character_count FROM appearances a JOIN roles r ON r.id = a.role_id
       GROUP BY r.name""", "appearances", "roles"))
def _(t):
    return views.v_role_stats(t)


@query("v_studio_stats", with_views(
    """SELECT s.id, s.name, (SELECT count(*) FROM characters c WHERE c.studio_id = s.id) AS character_count,
         (SELECT count(*) FROM films f WHERE f.studio_id = s.id) AS film_count,
         (SELECT count(*) FROM franchises fr WHERE fr.studio_id = s.id) AS franchise_count
       FROM studios s""", "studios", "characters", "films", "franchises"))
def _(t):
    return views.v_studio_stats(t)


# ---------------------------------------------------------------- marts

FILMS_COMPLETE = """SELECT f.id, m.title, m.year, f.animation_type, s.name AS studio_name, s.status AS studio_status,
    fr.name AS franchise_name, CAST(t.total_revenue AS DOUBLE) AS total_revenue,
    CAST(t.opening_week_revenue AS DOUBLE) AS opening_week_revenue, t.weeks_in_release
  FROM films f JOIN media m ON m.id = f.media_id LEFT JOIN studios s ON s.id = f.studio_id
  LEFT JOIN franchises fr ON fr.id = m.franchise_id LEFT JOIN total t ON t.film_id = f.id"""


@query("films_complete", with_views(FILMS_COMPLETE, "films", "media", "studios", "franchises", "total"))
def _(t):
    return marts.films_complete(t)


@query("films_complete_without_revenue", with_views(
    """SELECT f.id, m.title, m.year, f.animation_type, s.name AS studio_name, s.status AS studio_status,
         fr.name AS franchise_name, CAST(NULL AS DOUBLE) AS total_revenue, CAST(NULL AS DOUBLE) AS opening_week_revenue,
         CAST(NULL AS INTEGER) AS weeks_in_release
       FROM films f JOIN media m ON m.id = f.media_id LEFT JOIN studios s ON s.id = f.studio_id
       LEFT JOIN franchises fr ON fr.id = m.franchise_id""", "films", "media", "studios", "franchises"))
def _(t):
    return marts.films_complete(t, with_revenue=False)


CHARACTERS_COMPLETE = """SELECT c.id, c.name, c.franchise, r.name AS role, g.name AS gender, c.species, c.first_appearance_year,
    coalesce(n.n, 0) AS appearance_count, coalesce(n.actors, '') AS voice_actors_str
  FROM characters c LEFT JOIN roles r ON r.id = c.role_id LEFT JOIN genders g ON g.id = c.gender_id
  LEFT JOIN (SELECT character_id, count(*) AS n, string_agg(DISTINCT t.name, ', ' ORDER BY t.name) AS actors
             FROM appearances a LEFT JOIN talent t ON t.id = a.talent_id GROUP BY character_id) n ON n.character_id = c.id"""


@query("characters_complete", with_views(CHARACTERS_COMPLETE, "characters", "roles", "genders", "appearances", "talent"))
def _(t):
    return marts.characters_complete(t)


@query("boxoffice_summary", with_views(
    """SELECT t.film_title, t.film_year, CASE WHEN f.id IS NOT NULL THEN s.name END AS studio_name,
         CASE WHEN f.id IS NOT NULL THEN fr.name END AS franchise_name, CAST(total_revenue AS DOUBLE) AS total_revenue,
         CAST(opening_week_revenue AS DOUBLE) AS opening_week_revenue, weeks_in_release, days_in_release,
         avg_daily_revenue, states_reached
       FROM total t JOIN media m ON m.id = t.film_id LEFT JOIN films f ON f.id = t.film_id
       LEFT JOIN studios s ON s.id = f.studio_id LEFT JOIN franchises fr ON fr.id = m.franchise_id""",
    "total", "media", "films", "studios", "franchises"))
def _(t):
    return marts.boxoffice_summary(t)


@query("studio_stats", with_views(
    f"""SELECT st.*, c.character_count, c.unique_voice_actors, a.distinct_voice_actors
       FROM (SELECT s.name AS studio_name, s.status AS studio_status, count(*) AS film_count, min(m.year) AS first_film_year,
               max(m.year) AS last_film_year, CAST(sum(total_revenue) AS DOUBLE) AS total_box_office,
               CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS avg_box_office,
               count(DISTINCT fr.name) AS franchise_count
             FROM films f JOIN media m ON m.id = f.media_id JOIN studios s ON s.id = f.studio_id
             JOIN franchises fr ON fr.id = m.franchise_id LEFT JOIN total t ON t.film_id = f.id GROUP BY s.name, s.status) st
       LEFT JOIN (SELECT studio_name, count(*) AS character_count, count(DISTINCT voice_actors_str) AS unique_voice_actors
                  FROM ({CHARACTERS_COMPLETE}) cc JOIN owners o ON o.franchise = cc.franchise GROUP BY studio_name) c
         ON c.studio_name = st.studio_name
       LEFT JOIN (SELECT studio_name, count(DISTINCT talent_id) AS distinct_voice_actors
                  FROM appearances a JOIN characters ch ON ch.id = a.character_id JOIN owners o ON o.franchise = ch.franchise
                  GROUP BY studio_name) a ON a.studio_name = st.studio_name""".replace("owners", """(SELECT DISTINCT
           fr.name AS franchise, s.name AS studio_name FROM films f JOIN media m ON m.id = f.media_id
           JOIN studios s ON s.id = f.studio_id JOIN franchises fr ON fr.id = m.franchise_id)"""),
    "films", "media", "studios", "franchises", "total", "characters", "roles", "genders", "appearances", "talent"))
def _(t):
    return marts.studio_stats(t).withColumn("character_count", F.col("character_count").cast("bigint"))


# ---------------------------------------------------------------- insights


@query("sequel_retention", with_views(
    """SELECT fr.name AS franchise, k.original, k.retained,
         round(100.0::DOUBLE * k.retained / k.original, 0) AS retention, q.sequels
       FROM (SELECT franchise_id, count(*) AS original, count(*) FILTER (WHERE in_later) AS retained
             FROM (SELECT m.franchise_id, a.character_id, bool_or(a.media_id = f.first_id) AS in_first,
                     bool_or(a.media_id <> f.first_id) AS in_later
                   FROM appearances a JOIN media m ON m.id = a.media_id
                   JOIN (SELECT franchise_id, id AS first_id FROM media
                         QUALIFY row_number() OVER (PARTITION BY franchise_id ORDER BY year, id) = 1) f
                     ON f.franchise_id = m.franchise_id
                   GROUP BY m.franchise_id, a.character_id)
             WHERE in_first GROUP BY franchise_id) k
       JOIN (SELECT franchise_id, count(*) - 1 AS sequels FROM media GROUP BY franchise_id) q ON q.franchise_id = k.franchise_id
       JOIN franchises fr ON fr.id = k.franchise_id""", "appearances", "media", "franchises"))
def _(t):
    return insights.sequel_retention(t)


@query("franchise_longevity", with_views(
    """SELECT f.name AS franchise, min(year) AS start_year, max(year) AS end_year, max(year) - min(year) AS span
       FROM media m JOIN franchises f ON f.id = m.franchise_id GROUP BY f.name""", "media", "franchises"))
def _(t):
    return insights.franchise_longevity(t)


@query("character_density", with_views(
    """SELECT s.name AS studio_name, CAST(coalesce(sum(n), 0) AS DOUBLE) / count(*) AS avg_characters, count(*) AS total_films
       FROM films f JOIN studios s ON s.id = f.studio_id
       LEFT JOIN (SELECT media_id, count(*) AS n FROM appearances GROUP BY media_id) a ON a.media_id = f.media_id
       GROUP BY s.name""", "films", "studios", "appearances"))
def _(t):
    return insights.character_density(t)


@query("female_leads_by_decade", with_views(
    """SELECT CAST(m.year // 10 * 10 AS INTEGER) AS decade, count(*) AS total, count(*) FILTER (WHERE g.name = 'female') AS female,
         round(100.0::DOUBLE * count(*) FILTER (WHERE g.name = 'female') / count(*), 0) AS percentage
       FROM appearances a JOIN roles r ON r.id = a.role_id JOIN characters c ON c.id = a.character_id
       JOIN genders g ON g.id = c.gender_id JOIN media m ON m.id = a.media_id WHERE r.name = 'protagonist' GROUP BY 1""",
    "appearances", "roles", "characters", "genders", "media"))
def _(t):
    return insights.female_leads_by_decade(t)


@query("co_appearances", with_views(
    """SELECT m.franchise_id, h.character_id AS source_id, o.character_id AS target_id, count(*) AS shared_titles
       FROM (SELECT m.franchise_id, a.character_id FROM appearances a JOIN media m ON m.id = a.media_id
             GROUP BY m.franchise_id, a.character_id
             QUALIFY row_number() OVER (PARTITION BY m.franchise_id ORDER BY count(*) DESC, a.character_id) = 1) h
       JOIN media m ON m.franchise_id = h.franchise_id
       JOIN appearances a ON a.media_id = m.id AND a.character_id = h.character_id
       JOIN appearances o ON o.media_id = m.id AND o.character_id <> h.character_id
       GROUP BY m.franchise_id, h.character_id, o.character_id""", "appearances", "media"))
def _(t):
    return insights.co_appearances(t)


@query("top_partners", with_views(
    """SELECT character_id, CAST(rank AS INTEGER) AS rank, partner_id, shared_titles
       FROM (SELECT a.character_id, b.character_id AS partner_id, count(*) AS shared_titles,
               row_number() OVER (PARTITION BY a.character_id ORDER BY count(*) DESC, b.character_id) AS rank
             FROM appearances a JOIN appearances b ON b.media_id = a.media_id AND b.character_id <> a.character_id
             GROUP BY a.character_id, b.character_id) WHERE rank <= 5""", "appearances"))
def _(t):
    return top_partners(t.character_appearances, 5)


@query("reach_by_level", with_views(
    """SELECT 'film' AS level, film_id AS key, count(DISTINCT report_date) AS distinct_days, count(DISTINCT state_code) AS states
       FROM daily WHERE film_id IS NOT NULL GROUP BY film_id
       UNION ALL SELECT 'studio', f.studio_id, count(DISTINCT report_date), count(DISTINCT state_code)
       FROM daily d JOIN films f ON f.id = d.film_id GROUP BY f.studio_id
       UNION ALL SELECT 'all', CAST(NULL AS BIGINT), count(DISTINCT report_date), count(DISTINCT state_code)
       FROM daily WHERE film_id IS NOT NULL""", "daily", "films"))
def _(t):
    return bo.reach_by_level(t)


@query("wins_by_decade", with_views(
    """SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(*) FILTER (WHERE outcome = 'won') AS wins, count(*) AS entries
       FROM nominations GROUP BY 1""", "nominations"))
def _(t):
    return insights.wins_by_decade(t)


@query("award_entry_counts", with_views(
    """SELECT count(*) AS entries, count(*) FILTER (WHERE outcome = 'won') AS wins,
         count(*) FILTER (WHERE outcome <> 'won') AS nominations FROM nominations""", "nominations"))
def _(t):
    return insights.award_entry_counts(t)


@query("songs_per_era", with_views(
    """SELECT CASE WHEN m.year <= 1959 THEN 'Golden Age' WHEN m.year <= 1988 THEN 'Dark Age' WHEN m.year <= 1999 THEN 'Renaissance'
         WHEN m.year <= 2009 THEN 'Experimental' ELSE 'Revival' END AS era,
         CAST(coalesce(sum(n), 0) AS DOUBLE) / count(*) AS avg_songs, count(*) AS albums
       FROM soundtracks st JOIN media m ON m.id = st.media_id
       LEFT JOIN (SELECT soundtrack_id, count(*) AS n FROM songs GROUP BY soundtrack_id) s ON s.soundtrack_id = st.id
       GROUP BY 1""", "soundtracks", "media", "songs"))
def _(t):
    return insights.songs_per_era(t)


@query("composer_frequency", with_views(
    """SELECT t.name AS composer, count(DISTINCT s.soundtrack_id) AS albums FROM song_credits sc
       JOIN credit_types ct ON ct.id = sc.credit_type_id AND ct.name = 'composer' JOIN songs s ON s.id = sc.song_id
       JOIN talent t ON t.id = sc.talent_id GROUP BY t.name ORDER BY 2 DESC, 1 LIMIT 10""",
    "song_credits", "credit_types", "songs", "talent"))
def _(t):
    return insights.composer_frequency(t)


@query("most_recent_films", with_views(
    """SELECT f.id AS film_id, f.media_id, m.title, m.year FROM films f JOIN media m ON m.id = f.media_id
       ORDER BY m.year DESC, f.id LIMIT 50""", "films", "media"))
def _(t):
    return insights.most_recent_films(t)


@query("film_list_by_title", with_views(
    """SELECT f.id AS film_id, f.media_id, f.studio_id, m.title, m.year FROM films f JOIN media m ON m.id = f.media_id
       WHERE f.studio_id = 7""", "films", "media"))
def _(t):
    return insights.film_list(t, by="title", studio_id=7)


# ---------------------------------------------------------------- filters and joins


@query("facet_filter", with_views(
    """SELECT * FROM dashboard_characters WHERE lower(name) LIKE '%00%' AND role = 'villain' AND studio_id = 7
       ORDER BY name LIMIT 100""", "dashboard_characters"))
def _(t):
    found = rel.facet_filter(t.dashboard_characters, "name", "00", role="villain", studio_id="7", gender="all")
    return rel.top_k(found, 100, F.asc("name"))


@query("search_substring", with_views(
    """SELECT * FROM dashboard_characters WHERE contains(lower(name), 'actor 8') OR contains(lower(voice_actor), 'actor 8')
         OR contains(lower(species), 'actor 8') ORDER BY name LIMIT 100""", "dashboard_characters"))
def _(t):
    return rel.search(t.dashboard_characters, ["name", "voice_actor", "species"], "Actor 8", [F.col("name")])


@query("point_lookup", with_views("SELECT * FROM films WHERE id = 101", "films"))
def _(t):
    return rel.point_lookup(t.films, "id", 101)


@query("rows_of_studio", with_views("SELECT * FROM characters WHERE studio_id = 7", "characters"))
def _(t):
    return rel.rows_of(t.characters, "studio_id", 7, F.asc("name"))


@query("json_array_member", with_views(
    "SELECT id, name FROM dashboard_characters WHERE film_ids LIKE '%\"film-101\"%'", "dashboard_characters"))
def _(t):
    return people.film_cast(t.dashboard_characters, "film-101").select("id", "name")


@query("join_array_member", with_views(
    """SELECT c.id, c.name, f.id AS film_id, f.title, f.year FROM cast_films c JOIN dashboard_films f ON f.id = c.film_id""",
    "cast_films", "dashboard_films"))
def _(t):
    films = t.dashboard_films.select(F.col("id").alias("film_id"), "title", "year")
    return rel.members_of(t.dashboard_characters.select("id", "name", "film_ids"), "film_ids", films, "film_id").drop("film_ids")


@query("join_composite", with_views(
    """SELECT e.event_id, f.id AS film_id FROM event_reports e JOIN media m ON m.id = e.film_id
       LEFT JOIN (SELECT f.id, m.title, m.year FROM films f JOIN media m ON m.id = f.media_id) f
         ON f.title = m.title AND f.year = m.year""", "event_reports", "media", "films"))
def _(t):
    titles = t.media.select(F.col("id").alias("film_id"), "title", "year")
    events = t.event_reports().join(titles, "film_id").select("event_id", "title", "year")
    films = t.films.select(F.col("id").alias("media_id")).join(t.media.withColumnRenamed("id", "media_id"), "media_id")
    return rel.composite_lookup(events, films, {"title": "title", "year": "year"}, {"media_id": "film_id"}).select(
        "event_id", "film_id")


@query("fill_missing_counts", with_views(
    """SELECT c.id, count(a.media_id) AS appearance_count FROM characters c LEFT JOIN appearances a ON a.character_id = c.id
       GROUP BY c.id""", "characters", "appearances"))
def _(t):
    return rel.with_child_count(t.characters.select("id"), t.character_appearances, "character_id", "appearance_count")


@query("concat_extracts", with_views(
    """SELECT id, title, year, NULL AS studio_id FROM media WHERE media_type = 'game'
       UNION ALL SELECT f.id, m.title, NULL AS year, f.studio_id FROM films f JOIN media m ON m.id = f.media_id""",
    "media", "films"))
def _(t):
    games = t.media.filter(F.col("media_type") == "game").select("id", "title", "year")
    films = t.films.join(t.media.select(F.col("id").alias("media_id"), "title"), "media_id").select("id", "title", "studio_id")
    return rel.concat_extracts(games, films)
