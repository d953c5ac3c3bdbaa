"""DuckDB statements of the constraint, document and mutation queries."""

from __future__ import annotations

from cinemetric.oracle_sql import ACTOR, AS_OF_7, AS_OF_30, AVG, DOC_CTES, EVENTS, GL, LINE_SEQ, LOADS, RS, STAGE_CTES, TITLE, TREND_CTE, with_views


def _reasons(pairs: list[tuple[str, str]]) -> str:
    if not pairs:
        return "CAST([] AS VARCHAR[])"
    return "list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs) + "], lambda x: x IS NOT NULL)"


def _checked(name: str, raw: str, local: list[tuple[str, str]], parents: list[tuple[str, str, str]], keys: list[str], then: str = "") -> str:
    """CTEs ``name_ok`` (accepted rows) and ``name_bad`` (all rows with their reasons)."""
    orphans = [(f"unknown {c} in {p}", f"r.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}_ok q WHERE q.{pc} = r.{c})") for c, p, pc in parents]
    clashes = []
    for key in keys:
        named = " AND ".join(f"{c.strip()} IS NOT NULL" for c in key.split(","))
        place = f"row_number() OVER (PARTITION BY len(bad) = 0 AND {named}, {key} ORDER BY seq{then})"
        clashes.append((f"duplicate ({key})", f"len(bad) = 0 AND {named} AND {place} > 1"))
    return f"""{name}_raw AS ({raw}),
{name}_local AS (SELECT r.*, {_reasons(local + orphans)} AS bad FROM {name}_raw r),
{name}_bad AS (SELECT * EXCLUDE (bad), list_concat(bad, {_reasons(clashes)}) AS reasons FROM {name}_local),
{name}_ok AS (SELECT * FROM {name}_bad WHERE len(reasons) = 0)"""


_MOVIE = ("movie_id", "movies", "movie_id")
_PERSON = ("person_id", "people", "person_id")
_LINE = "lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber"
_TABLES = [
    _checked("movies", """
SELECT CASE WHEN p_partkey % 29 = 0 THEN 0 ELSE p_partkey + 1 END AS movie_id,
       CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN repeat(p_name, 60) ELSE p_name END AS title,
       CASE WHEN p_partkey % 41 = 0 THEN repeat(p_brand, 8) ELSE p_brand END AS language, p_partkey * 2 AS seq FROM part
UNION ALL SELECT p_partkey + 1, 'Second', p_brand, p_partkey * 2 + 1 FROM part WHERE p_partkey % 37 = 0""",
        [("movie_id is required", "movie_id IS NULL"), ("movie_id must be > 0", "movie_id <= 0"), ("title is required", "title IS NULL"),
         ("title longer than 255", "length(title) > 255"), ("language longer than 50", "length(language) > 50")], [], ["movie_id"]),
    _checked("genres", """
SELECT n_nationkey + 1 AS genre_id, n_name AS genre_name, n_nationkey AS seq FROM nation
UNION ALL SELECT r_regionkey + 100, CASE r_regionkey WHEN 1 THEN 'NATION_1' WHEN 0 THEN NULL ELSE r_name END, r_regionkey + 1000 FROM region""",
        [("genre_name is required", "genre_name IS NULL"), ("genre_name longer than 100", "length(genre_name) > 100")], [], ["genre_id", "genre_name"]),
    _checked("production_companies", """
SELECT s_suppkey + 1 AS company_id, CASE WHEN s_suppkey % 53 = 0 THEN 'Supplier duplicate' WHEN s_suppkey % 59 = 0 THEN NULL ELSE s_name END AS name,
       s_suppkey AS seq FROM supplier""",
        [("name is required", "name IS NULL"), ("name longer than 255", "length(name) > 255")], [], ["company_id", "name"]),
    _checked("ratings", f"""
SELECT l_orderkey * 10 + l_linenumber AS rating_id, CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey END AS user_id,
       l_partkey + CASE WHEN l_partkey % 89 = 0 THEN 10000000 ELSE 1 END AS movie_id, CAST(l_quantity AS INTEGER) % 13 AS rating,
       l_orderkey * 10 + l_linenumber AS seq FROM {_LINE} IN (5, 6)""",
        [("rating below 0", "rating < 0"), ("rating above 10", "rating > 10")], [_MOVIE], ["rating_id", "user_id, movie_id"], ", movie_id, user_id NULLS FIRST, rating"),
    _checked("keywords", """
SELECT p_partkey + 1 AS keyword_id, CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE p_name END AS keyword_name, p_partkey AS seq FROM part""",
        [("keyword_name is required", "keyword_name IS NULL")], [], ["keyword_id", "keyword_name"]),
    _checked("people", """
SELECT c_custkey + 1 AS person_id, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 67 = 0 THEN c_custkey + 2 ELSE c_custkey + 1 END AS tmdb_id,
       CASE WHEN c_custkey % 71 = 0 THEN repeat(c_name, 20) ELSE c_name END AS name, c_custkey AS seq FROM customer""",
        [("name longer than 255", "length(name) > 255")], [], ["person_id", "tmdb_id"]),
    _checked("users", """
SELECT CASE WHEN c_custkey % 73 = 0 THEN NULL ELSE c_custkey END AS user_id, CASE WHEN c_custkey % 79 = 0 THEN 'guest' ELSE c_name END AS username,
       CASE WHEN c_custkey % 83 = 0 THEN repeat('r', 21) ELSE 'user' END AS role, c_custkey AS seq FROM customer""",
        [("user_id is required", "user_id IS NULL"), ("username longer than 50", "length(username) > 50"), ("role longer than 20", "length(role) > 20")],
        [], ["user_id", "username"]),
    _checked("movie_genres", """
SELECT l_partkey + 1 AS movie_id, s_nationkey + 1 AS genre_id, l_orderkey * 10 + 1 AS seq
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 1""", [], [_MOVIE, ("genre_id", "genres", "genre_id")], ["movie_id, genre_id"]),
    _checked("movie_production_companies", """
SELECT l_partkey + 1 AS movie_id, l_suppkey + 1 AS company_id, l_orderkey * 10 + 2 AS seq FROM lineitem WHERE l_linenumber = 2""",
        [], [_MOVIE, ("company_id", "production_companies", "company_id")], ["movie_id, company_id"]),
    _checked("movie_keywords", """
SELECT l_partkey + 1 AS movie_id, l_orderkey % 500 + 1 AS keyword_id, l_orderkey * 10 + 7 AS seq FROM lineitem WHERE l_linenumber = 7""",
        [], [_MOVIE, ("keyword_id", "keywords", "keyword_id")], ["movie_id, keyword_id"]),
    _checked("movie_cast", f"""
SELECT l_partkey + 1 AS movie_id, o_custkey + 1 AS person_id, o_orderpriority AS character, CAST(l_quantity AS INTEGER) % 10 AS cast_order, 'c' || (l_orderkey % 5000) AS credit_id,
       l_orderkey * 10 + 3 AS seq FROM {_LINE} = 3""",
        [("character longer than 255", "length(character) > 255"), ("credit_id longer than 50", "length(credit_id) > 50")],
        [_MOVIE, _PERSON], ["movie_id, person_id", "credit_id"], ", movie_id, person_id, character, cast_order"),
    _checked("movie_crew", f"""
SELECT l_partkey + 1 AS movie_id, o_custkey + 1 AS person_id, o_orderstatus AS department,
       CASE WHEN CAST(l_quantity AS INTEGER) % 47 = 0 THEN repeat(o_orderpriority, 20) ELSE o_orderpriority END AS job,
       'w' || l_orderkey || CASE WHEN CAST(l_quantity AS INTEGER) % 31 = 0 THEN repeat('x', 50) ELSE '' END AS credit_id,
       l_orderkey * 10 + 4 AS seq FROM {_LINE} = 4""",
        [("department longer than 100", "length(department) > 100"), ("job longer than 100", "length(job) > 100"),
         ("credit_id longer than 50", "length(credit_id) > 50")], [_MOVIE, _PERSON], ["movie_id, person_id, job", "credit_id"], ", movie_id, person_id, job, credit_id"),
]
_NAMES = [
    "movies", "genres", "production_companies", "ratings", "keywords", "people", "users", "movie_genres", "movie_production_companies",
    "movie_keywords", "movie_cast", "movie_crew",
]
_WITH = "WITH " + ",\n".join(_TABLES) + "\n"

CHECKS: dict[str, str] = {
    "schema_reason_counts": _WITH + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, reason, count(*) AS rows FROM "
        f"(SELECT unnest(CASE WHEN len(reasons) = 0 THEN ['accepted'] ELSE reasons END) AS reason FROM {n}_bad) t GROUP BY reason"
        for n in _NAMES
    ),
    "schema_rejected_credits": _WITH + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, seq, CAST(movie_id AS INTEGER) AS movie_id, CAST(person_id AS INTEGER) AS person_id, credit_id, "
        f"array_to_string(reasons, '; ') AS reasons FROM {n}_bad WHERE len(reasons) > 0"
        for n in ("movie_cast", "movie_crew")
    ),
}


# Collections: (reason, table, condition of the documents that break it), straight from the driver tables.
_EVENT_TYPES = "('page_view', 'view', 'search', 'click', 'add_to_cart', 'remove_from_cart', 'checkout', 'purchase', 'rating_submitted')"
_PREFS = "c_custkey % 29 <> 0 AND "
_DOC = "o_orderkey % 41 <> 0 AND o_orderkey % 43 <> 0 AND "
_FAULTS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "events": ("events", [
        ("type is required", "event_id % 37 = 0"), ("type not allowed", f"event_id % 37 <> 0 AND event_type NOT IN {_EVENT_TYPES}"),
        ("user_id must be int or null", "event_id % 13 = 0 AND event_id % 11 <> 0"), ("movie_id must be int or null", "event_id % 17 = 0"),
        ("timestamp is required", "event_id % 19 = 0"), ("timestamp must be date", "event_id % 23 = 0 AND event_id % 19 <> 0"),
        ("session_id must be string", "event_id % 29 = 0"), ("metadata must be object", "event_id % 31 = 0"),
    ]),
    "user_profiles": ("customer", [
        ("user_id must be int", "c_custkey % 7 = 0"), ("preferences must be object", "c_custkey % 29 = 0"),
        ("preferences.favorite_genres[] must be string", _PREFS + "c_custkey % 11 = 0"),
        ("preferences.favorite_actors must be array", _PREFS + "c_custkey % 17 = 0"),
        ("preferences.viewing_history[].duration_seconds must be int", _PREFS + "c_custkey % 13 = 0"),
        ("recommendations[].score must be double", "c_custkey % 23 = 0"),
        ("activity_summary.total_views must be int", "c_custkey % 19 = 0"), ("last_updated is required", "c_custkey % 31 = 0"),
    ]),
    "movie_aggregates": ("part", [
        ("movie_id must be int", "p_partkey % 29 = 0"), ("views.hourly must be object", "p_partkey % 7 = 0"),
        ("engagement must be object", "p_partkey % 11 = 0"),
        ("engagement.click_rate must be double", "p_partkey % 13 = 0 AND p_partkey % 11 <> 0"), ("computed_at must be date", "p_partkey % 17 = 0"),
    ]),
    "sessions": ("orders", [
        ("document must be object", "o_orderkey % 41 = 0 OR o_orderkey % 43 = 0"), ("session_id must be string", _DOC + "o_orderkey % 19 = 0"),
        ("started_at must be date", _DOC + "o_orderkey % 11 = 0"), ("ended_at must be date or null", _DOC + "o_orderkey % 5 = 0 AND o_orderkey % 3 <> 0"),
        ("page_views must be int", _DOC + "o_orderkey % 13 = 0"), ("device_info.os must be string", _DOC + "o_orderkey % 17 = 0"),
    ]),
    "recommendations": ("customer", [
        ("movies is required", "c_custkey % 13 = 0"), ("movies must be array", "c_custkey % 17 = 0 AND c_custkey % 13 <> 0"),
        ("movies[].movie_id is required", "c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 5 = 0"),
        ("movies[].score is required", "c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 7 = 0"),
        ("algorithm must be string", "c_custkey % 19 = 0"),
    ]),
}


def _fault_counts() -> str:
    parts = []
    for name, (table, faults) in _FAULTS.items():
        rows = [(reason, cond) for reason, cond in faults] + [("accepted", " AND ".join(f"NOT ({cond})" for _, cond in faults))]
        parts += [f"SELECT '{name}' AS table_name, '{reason}' AS reason, count(*) AS rows FROM {table} WHERE {cond} HAVING count(*) > 0" for reason, cond in rows]
    return "\nUNION ALL\n".join(parts)


_RATING = "(CAST(l_quantity AS INTEGER) - 5) / 4.0"
CHECKS["document_reason_counts"] = _fault_counts()
CHECKS["rating_change_outcomes"] = f"""
SELECT array_to_string(list_filter([
         CASE WHEN o_custkey % 13 = 0 THEN 'userId is required' END,
         CASE WHEN l_partkey % 17 = 0 AND l_partkey % 11 <> 0 THEN 'rating is required' END,
         CASE WHEN l_partkey % 11 = 0 THEN 'rating must be int or double' END,
         CASE WHEN l_partkey % 11 <> 0 AND l_partkey % 17 <> 0 AND {_RATING} < 0 THEN 'rating below 0' END,
         CASE WHEN l_partkey % 11 <> 0 AND l_partkey % 17 <> 0 AND {_RATING} > 5 THEN 'rating above 5' END], lambda x: x IS NOT NULL), '; ') AS reasons,
       count(*) AS rows
FROM {_LINE} = 6 GROUP BY reasons"""

# Members of a cast: those of the movie's credits, wherever the mixed field holds a list of them.
_MIXED = "CASE WHEN id % 13 = 0 OR (id % 4 > 1 AND id % 11 = 0) THEN [] ELSE \"cast\" END"
CHECKS["mixed_cast_lists"] = with_views(f"""
SELECT id, CAST(len({_MIXED}) AS INTEGER) AS members, coalesce(array_to_string(list_transform({_MIXED}, lambda x: x.name), ', '), '') AS names
FROM cdocs""", DOC_CTES)
CHECKS["mixed_lists_converted"] = with_views("""
SELECT count(*) AS converted, CAST(coalesce(sum(len("cast")), 0) AS BIGINT) AS members FROM cdocs WHERE id % 13 <> 0 AND id % 4 < 2""", DOC_CTES)
CHECKS["numeric_id_documents"] = with_views("SELECT id FROM cdocs WHERE id % 5 <> 0", DOC_CTES)
CHECKS["nested_preference_genres"] = """
SELECT CASE WHEN c_custkey % 11 = 0 THEN 'Drama' ELSE c_mktsegment END AS genre, count(*) AS profiles
FROM customer WHERE c_custkey % 29 <> 0 GROUP BY genre"""


# Tables after a batch.
_FIRST_CHANGE = f"""first_change AS (
  SELECT user_id, movie_id, rating FROM (
    SELECT o_custkey AS user_id, CAST(l_partkey + 1 AS INT) AS movie_id, CAST(l_quantity / 10 AS DECIMAL(3,1)) AS rating,
           row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY {LINE_SEQ}) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 6) t WHERE rn = 1)"""
CHECKS["ratings_table_upserted"] = with_views("""
SELECT user_id, movie_id, rating FROM ratings WHERE (user_id, movie_id) NOT IN (SELECT (user_id, movie_id) FROM change_rows)
UNION ALL SELECT user_id, movie_id, rating FROM change_rows""", STAGE_CTES)
CHECKS["ratings_table_inserted"] = with_views("""
SELECT user_id, movie_id, rating FROM ratings
UNION ALL SELECT user_id, movie_id, rating FROM first_change WHERE (user_id, movie_id) NOT IN (SELECT (user_id, movie_id) FROM ratings)""", _FIRST_CHANGE)
CHECKS["ratings_table_deleted"] = with_views("""
SELECT user_id, movie_id, rating FROM ratings WHERE (user_id, movie_id) NOT IN (SELECT (user_id, movie_id) FROM first_change)""", _FIRST_CHANGE)


def _left(tables: list[tuple[str, str, str, str]], gone: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, concat_ws(':', {key}) AS key FROM {source} WHERE {column} NOT IN ({gone})" for name, source, column, key in tables
    )


CHECKS["movie_cascade_tables"] = with_views(_left(
    [("movies", "movies", "movie_id", "movie_id"), ("ratings", "ratings", "movie_id", "movie_id, user_id")]
    + [(n, n, "movie_id", k) for n, k in (
        ("movie_genres", "movie_id, genre_id"), ("movie_production_companies", "movie_id, company_id"), ("movie_keywords", "movie_id, keyword_id"),
        ("movie_cast", "movie_id, person_id"), ("movie_crew", "movie_id, person_id, job"))],
    "SELECT movie_id FROM movies WHERE popularity IS NULL"))
CHECKS["movie_document_cascade"] = with_views(_left(
    [("movies", "movies", "movie_id", "movie_id"), ("credits", "cdocs", "id", "id"),
     ("keywords", "(SELECT DISTINCT movie_id FROM movie_keywords)", "movie_id", "movie_id"), ("ratings", "ratings", "movie_id", "movie_id, user_id")],
    "SELECT movie_id FROM movies WHERE released_date IS NULL"), DOC_CTES)
CHECKS["user_cascade_tables"] = with_views(_left(
    [("users", "(SELECT c_custkey AS user_id FROM customer WHERE c_custkey % 3 <> 0)", "user_id", "user_id"),
     ("ratings", "ratings", "user_id", "user_id, movie_id")],
    "SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 AND c_mktsegment = 'BUILDING'"))

# Partial states: the same as everything at once.
CHECKS["trending_from_states"] = EVENTS["trending_scores"]
CHECKS["view_counts_from_states"] = EVENTS["movie_view_buckets_hourly"]
CHECKS["movie_aggregate_documents"] = with_views("""
SELECT a.movie_id, coalesce(h.t, '') AS hourly, coalesce(d.t, '') AS daily, a.v AS views_total,
       CAST(a.c AS DOUBLE) / nullif(CAST(a.v AS DOUBLE), 0) AS click_rate, CAST(a.k AS DOUBLE) / nullif(CAST(a.v AS DOUBLE), 0) AS add_to_cart_rate,
       CAST(a.b AS DOUBLE) / nullif(CAST(a.v AS DOUBLE), 0) AS conversion_rate, tr.trending_score
FROM (SELECT movie_id, CAST(count_if(type = 'page_view') AS BIGINT) AS v, count_if(type = 'click') AS c, count_if(type = 'add_to_cart') AS k,
             count_if(type = 'purchase') AS b FROM media_events WHERE movie_id IS NOT NULL GROUP BY movie_id) a
LEFT JOIN tr ON tr.movie_id = a.movie_id
LEFT JOIN (SELECT movie_id, string_agg(k || '=' || n, ', ' ORDER BY k) AS t FROM hv GROUP BY movie_id) h ON h.movie_id = a.movie_id
LEFT JOIN (SELECT movie_id, string_agg(k || '=' || n, ', ' ORDER BY k) AS t FROM dv GROUP BY movie_id) d ON d.movie_id = a.movie_id""", TREND_CTE + """,
hv AS (SELECT movie_id, strftime(ts, '%Y-%m-%d %H:00') AS k, count(*) AS n FROM media_events
       WHERE type = 'page_view' AND movie_id IS NOT NULL GROUP BY ALL),
dv AS (SELECT movie_id, strftime(ts, '%Y-%m-%d') AS k, count(*) AS n FROM media_events
       WHERE type = 'page_view' AND movie_id IS NOT NULL GROUP BY ALL)""")

# Look-ups, lists and siblings.
CHECKS["titles_found"] = with_views(f"SELECT movie_id, title, released_date FROM movies WHERE title ILIKE '%{TITLE}%'")
CHECKS["movies_found"] = CHECKS["name_search_movies"] = with_views(f"SELECT movie_id, title FROM movies WHERE title ILIKE '%{TITLE}%'")
CHECKS["people_found"] = CHECKS["name_search_people"] = with_views(
    f"SELECT person_id, name, gender FROM people WHERE name ILIKE '%{ACTOR}%' ORDER BY name NULLS LAST, person_id LIMIT 50")
CHECKS["list_companies"] = with_views("SELECT company_id, name FROM production_companies")
CHECKS["list_ratings"] = with_views("SELECT rating_id, user_id, movie_id, rating FROM ratings")
CHECKS["list_links_genres"] = with_views("SELECT movie_id, genre_id FROM movie_genres")
CHECKS["list_links_companies"] = with_views("SELECT movie_id, company_id FROM movie_production_companies")
CHECKS["list_links_crew"] = with_views("SELECT movie_id, person_id, department, job FROM movie_crew")
CHECKS["genre_classes"] = with_views("""
SELECT movie_id, CAST(count(*) AS INTEGER) AS n_members, string_agg(genre_name, ', ' ORDER BY genre_name, genre_id) AS names
FROM movie_genres JOIN genres USING (genre_id) GROUP BY movie_id""")
CHECKS["company_classes"] = with_views("""
SELECT movie_id, CAST(count(*) AS INTEGER) AS n_members, string_agg(name, ', ' ORDER BY name, company_id) AS names
FROM movie_production_companies JOIN production_companies USING (company_id) GROUP BY movie_id""")
CHECKS["company_siblings_requested"] = with_views("""
SELECT r.movie_id, r.company_id, coalesce((
  SELECT string_agg(pc.name, ', ' ORDER BY pc.name, pc.company_id) FROM movie_production_companies b JOIN production_companies pc USING (company_id)
  WHERE b.movie_id = r.movie_id AND b.company_id <> r.company_id), '') AS others
FROM (SELECT company_id, min(movie_id) AS movie_id FROM movie_production_companies GROUP BY company_id) r""")
CHECKS["ratings_browse_random"] = with_views(f"""
SELECT m.movie_id, m.title, m.released_date, nullif(CAST({AVG} AS DOUBLE), 0) AS avg_rating, rs.n AS num_ratings, gl.genres,
       CAST(nullif(m.popularity, 0) AS DOUBLE) AS popularity
FROM movies m JOIN rs ON rs.movie_id = m.movie_id LEFT JOIN gl ON gl.movie_id = m.movie_id
ORDER BY md5('42:' || m.movie_id), m.movie_id LIMIT 100""", RS + ", " + GL)

# Measurements: sorted[int(0.95 n)] from 20 runs on, else the largest.
_LATENCY = """runs AS (
  SELECT 'test ' || (l_linenumber % 3) AS test, CASE WHEN l_suppkey % 2 = 0 THEN 'a' ELSE 'b' END AS engine,
         CAST(CAST(l_quantity AS INTEGER) * 4 + l_partkey % 4 AS DOUBLE) AS v FROM lineitem),
report AS (
  SELECT test, engine, round(avg(v), 3) AS avg_latency_ms, round(median(v), 3) AS median_latency_ms,
         CASE WHEN count(*) >= 20 THEN list_sort(list(v))[CAST(floor(count(*) * 0.95) AS INTEGER) + 1] ELSE max(v) END AS p95_latency_ms,
         min(v) AS min_latency_ms, max(v) AS max_latency_ms, sum(v) AS total_time_ms, round(count(*) / (sum(v) / 1000), 2) AS ops_per_sec, count(*) AS runs
  FROM runs GROUP BY test, engine)"""
CHECKS["latency_report"] = f"WITH {_LATENCY} SELECT * FROM report"
CHECKS["latency_winners"] = f"""WITH {_LATENCY},
long AS (UNPIVOT (SELECT * EXCLUDE (runs) FROM report) ON COLUMNS(* EXCLUDE (test, engine)) INTO NAME metric VALUE v)
SELECT a.test, a.metric, CASE WHEN a.v = b.v THEN 'tie' WHEN (a.metric = 'ops_per_sec') = (a.v > b.v) THEN 'a' ELSE 'b' END AS winner
FROM long a JOIN long b ON a.test = b.test AND a.metric = b.metric AND a.engine = 'a' AND b.engine = 'b'"""

# The credits load: a file row goes as a whole.
_CREDITS = DOC_CTES + """,
file_rows AS (
  SELECT CAST(id AS BIGINT) AS seq, CASE WHEN id % 17 <> 0 THEN id END AS movie_id,
         CASE WHEN id % 29 = 0 AND id % 19 <> 0 THEN [] ELSE "cast" END AS members, crew, id % 19 = 0 AS longer FROM cdocs
  UNION ALL SELECT id + 1000000, id + 500000, "cast", crew, false FROM cdocs WHERE id % 23 = 0),
judged AS (
  SELECT f.*, f.movie_id IS NULL AS no_id, f.movie_id IS NOT NULL AND f.longer AND len(f.members) > 0 AS too_long,
         o.movie_id IS NOT NULL AND f.seq > 1000000 AND ((len(o.members) > 0 AND len(f.members) > 0) OR len(f.crew) > 0) AS taken
  FROM file_rows f LEFT JOIN file_rows o ON o.seq = f.seq - 1000000),
good AS (SELECT * FROM judged WHERE NOT (no_id OR too_long OR taken))"""
CHECKS["credit_load_counts"] = with_views("""
SELECT 'input' AS measure, count(*) AS n FROM judged
UNION ALL SELECT 'accepted', count(*) FROM good
UNION ALL SELECT 'rejected', (SELECT count(*) FROM judged) - (SELECT count(*) FROM good)
UNION ALL SELECT 'movie_id is required', count(*) FROM judged WHERE no_id
UNION ALL SELECT 'member name too long', 0
UNION ALL SELECT 'member text too long', count(*) FROM judged WHERE too_long
UNION ALL SELECT 'credit_id is taken', count(*) FROM judged WHERE taken
UNION ALL SELECT 'cast rows', CAST(sum(len(members)) AS BIGINT) FROM good
UNION ALL SELECT 'crew rows', CAST(sum(len(crew)) AS BIGINT) FROM good""", _CREDITS)
CHECKS["credit_load_cast"] = with_views("""
SELECT CAST(movie_id AS INTEGER) AS movie_id, m.id AS person,
       'c' || (movie_id - CASE WHEN seq > 1000000 THEN 500000 ELSE 0 END) || '-' || m.id AS credit_id FROM (SELECT seq, movie_id, unnest(members) AS m FROM good)""", _CREDITS)

# People as their rows arrive: a row without id finds whoever has its name and path at its place.
CHECKS["ingest_people_in_order"] = """
WITH feed AS (
  SELECT CASE WHEN (o_custkey + l_orderkey) % 3 = 0 THEN NULL ELSE CAST(o_custkey % 400 AS BIGINT) END AS tmdb_id, 'person ' || (o_custkey % 90) AS name,
         CAST(o_custkey % 4 AS INTEGER) AS gender, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS profile_path,
         dense_rank() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_quantity) AS place
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 3),
spans AS (SELECT *, lead(place) OVER (PARTITION BY tmdb_id ORDER BY place) AS until FROM feed WHERE tmdb_id IS NOT NULL),
strangers AS (
  SELECT name, gender, profile_path, place FROM feed f WHERE tmdb_id IS NULL AND NOT EXISTS (
    SELECT 1 FROM spans s WHERE s.name = f.name AND s.profile_path IS NOT DISTINCT FROM f.profile_path
      AND s.place <= f.place AND (s.until IS NULL OR f.place < s.until))),
people AS (
  SELECT tmdb_id, name, gender, profile_path FROM (SELECT *, row_number() OVER (PARTITION BY tmdb_id ORDER BY place DESC) AS rn FROM feed WHERE tmdb_id IS NOT NULL)
  WHERE rn = 1
  UNION ALL SELECT NULL, name, gender, profile_path FROM (SELECT *, row_number() OVER (PARTITION BY name, profile_path ORDER BY place) AS rn FROM strangers) WHERE rn = 1)
SELECT *, CAST(row_number() OVER (ORDER BY tmdb_id NULLS FIRST, name NULLS FIRST, profile_path NULLS FIRST) AS INTEGER) AS person_id FROM people"""


# Files written, read back and parsed.
CHECKS["movies_from_csv"] = LOADS["ingest_movies_parsed"]
CHECKS["ratings_from_csv"] = with_views("SELECT CAST(user_id AS INTEGER) AS user_id, movie_id - 1 AS movie_id, rating, created_at FROM rating_rows", STAGE_CTES)
CHECKS["rating_documents_replaced"] = with_views("""
SELECT CAST(user_id AS INTEGER) AS "userId", movie_id - 1 AS "movieId", CAST(rating AS DOUBLE) AS rating, epoch_us(created_at) // 1000000 AS timestamp
FROM rating_rows""", STAGE_CTES)
CHECKS["keyword_documents_from_csv"] = with_views("""
SELECT movie_id AS id, CAST(count(*) AS INTEGER) AS n, string_agg(keyword_name, ', ' ORDER BY keyword_id) AS names
FROM movie_keywords JOIN keywords USING (keyword_id) GROUP BY movie_id""")
CHECKS["documents_from_json_arrays"] = with_views("""
SELECT id, title, runtime, coalesce(array_to_string(list_transform(genres, lambda x: coalesce(x.name, '')), ', '), '') AS genre_names FROM mdocs""", DOC_CTES)
CHECKS["links_from_csv"] = """
SELECT CAST(p_partkey AS INTEGER) AS "movieId", CAST(CASE WHEN p_partkey % 9 <> 0 THEN p_partkey + 1 END AS INTEGER) AS "tmdbId" FROM part"""
CHECKS["pruned_movie_columns"] = """
SELECT CAST(p_partkey + 1 AS VARCHAR) AS id,
       'adult,genres,id,original_language,original_title,overview,popularity,poster_path,production_companies,release_date,runtime,tagline' AS columns
FROM part"""
CHECKS["movie_embedded_objects"] = with_views("""
SELECT movie_id AS id, CASE WHEN movie_id % 3 = 0 THEN 'Set ' || language END AS name,
       CASE WHEN movie_id % 5 = 0 THEN '' WHEN movie_id % 7 = 0 THEN '-' ELSE right(language, 2) || '=Land''s end, XX=X' END AS countries,
       right(language, 2) || '=' || language AS languages FROM movies""")
CHECKS["presentation"] = with_views("""
SELECT movie_id, coalesce(strftime(released_date, '%Y-%m-%d'), 'N/A') AS released, coalesce(strftime(released_date, '%Y-%m-%d 00:00:00'), 'N/A') AS released_at,
       coalesce(printf('%.2f', CAST(popularity AS DOUBLE)), 'N/A') AS popularity, round(runtime / 60.0, 1) AS hours,
       CASE WHEN runtime / 5 >= 9 THEN '#28a745' WHEN runtime / 5 >= 7 THEN '#ffc107' WHEN runtime / 5 >= 5 THEN '#fd7e14' ELSE '#dc3545' END AS colour,
       'https://images/w500/' || movie_id || '.jpg' AS poster, CASE WHEN movie_id % 5 <> 0 THEN title END AS name,
       movie_id % 3 = 0 OR popularity IS NULL AS missing, array_to_string(string_split(overview, ' ')[1:2], ' ') AS lead,
       true AS literal_hit, false AS literal_miss FROM movies""")
CHECKS["cast_order_measures"] = with_views("""
SELECT id, CAST(len(o) AS INTEGER) AS n, list_min(o) AS least, list_max(o) AS greatest, CAST(list_sum(o) AS DOUBLE) / nullif(len(o), 0) AS mean
FROM (SELECT id, list_filter(list_transform("cast", lambda x: x."order"), lambda x: x IS NOT NULL) AS o FROM cdocs)""", DOC_CTES)

# Dimensions, bridges, upserts.
CHECKS["ingest_movie_companies"] = with_views("""
SELECT movie_id, d.company_id FROM movie_production_companies b JOIN production_companies pc ON pc.company_id = b.company_id JOIN dim d ON d.name = pc.name""", """
dim AS (SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS company_id, name FROM
        (SELECT DISTINCT name FROM movie_production_companies JOIN production_companies USING (company_id)) t)""")
CHECKS["ingest_keyword_dimension"] = with_views("""
SELECT CAST(row_number() OVER (ORDER BY keyword_name) AS INTEGER) AS keyword_id, keyword_name FROM (SELECT DISTINCT keyword_name FROM movie_keyword_names WHERE keyword_name <> '') t""")
CHECKS["ingest_movie_keywords"] = with_views("""
SELECT movie_id, keyword_id FROM movie_keyword_names JOIN (
  SELECT CAST(row_number() OVER (ORDER BY keyword_name) AS INTEGER) AS keyword_id, keyword_name FROM (SELECT DISTINCT keyword_name FROM movie_keyword_names WHERE keyword_name <> '') t)
  USING (keyword_name)""")
_UPSERTED = """upserted AS (
  SELECT movie_id, CASE WHEN movie_id % 4 = 0 THEN title || ' (new)' ELSE title END AS title, CASE WHEN movie_id % 4 <> 0 THEN popularity END AS popularity,
         released_date, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(movie_id % 700) AS created_at,
         coalesce(n, 0) + CASE WHEN movie_id % 4 = 0 THEN 1 ELSE 0 END AS genres
  FROM movies LEFT JOIN (SELECT movie_id, count(*) AS n FROM movie_genres GROUP BY movie_id) g USING (movie_id))"""
CHECKS["ingest_movies_upsert"] = with_views("SELECT * FROM upserted", _UPSERTED)
CHECKS["recent_movies"] = with_views("""
SELECT movie_id, title, released_date, CAST(nullif(popularity, 0) AS DOUBLE) AS popularity FROM upserted ORDER BY created_at DESC, movie_id LIMIT 100""", _UPSERTED)
CHECKS["link_page_summary"] = with_views("SELECT count(DISTINCT movie_id) AS unique_movies, count(DISTINCT genre_id) AS unique_dims FROM movie_genres")

# Tables that single changes leave.
CHECKS["ratings_after_strict_insert"] = with_views(f"""
SELECT user_id, movie_id, rating, created_at FROM ratings
UNION ALL SELECT user_id, movie_id, rating, TIMESTAMP '{AS_OF_7}' FROM first_change WHERE (user_id, movie_id) NOT IN (SELECT (user_id, movie_id) FROM ratings)""", _FIRST_CHANGE)
CHECKS["companies_after_guarded_delete"] = with_views("""
SELECT company_id, name FROM production_companies WHERE name NOT ILIKE '%0%'
  OR company_id IN (SELECT company_id FROM movie_production_companies WHERE company_id % 2 = 0)""")
CHECKS["cast_after_checked_insert"] = with_views("""
SELECT movie_id, person_id, character, cast_order FROM movie_cast
WHERE movie_id % 2 = 0 OR movie_id IN (SELECT movie_id FROM movies WHERE popularity IS NOT NULL)""")
CHECKS["documents_company_edits"] = with_views("""
SELECT id AS movie_id, array_to_string(list_transform(a, lambda x, i: x.id || ':' || CASE WHEN i = list_position(hit, true) THEN 'FIRST' ELSE x.name END), ', ') AS companies
FROM (SELECT id, a, list_transform(a, lambda x: contains(x.name, '0')) AS hit FROM (
  SELECT id, CASE WHEN production_companies IS NULL THEN [{'id': CAST(3 AS BIGINT), 'name': 'ADDED'}]
                  WHEN len(list_filter(production_companies, lambda x: x.id = 3)) > 0 THEN production_companies
                  ELSE list_append(production_companies, {'id': CAST(3 AS BIGINT), 'name': 'ADDED'}) END AS a FROM mdocs) t) u""", DOC_CTES)
CHECKS["documents_credit_edits"] = with_views("""
SELECT id, coalesce(array_to_string(list_transform("cast", lambda x, i: x.name || '=' || CASE WHEN i = list_position(hit, true) THEN 'EDITED' ELSE x.character END), ', '), '') AS cast,
       coalesce(array_to_string(list_transform(crew, lambda x: x.name || '=' || x.job || '=' || CASE WHEN x.job = '1-URGENT' THEN 'D' ELSE x.department END), ', '), '') AS crew
FROM (SELECT *, list_transform("cast", lambda x: contains(x.name, '1')) AS hit FROM cdocs) t""", DOC_CTES)
CHECKS["sessions_retained"] = with_views(f"""
SELECT session_id, min(ts) AS started_at FROM media_events GROUP BY session_id HAVING min(ts) >= TIMESTAMP '{AS_OF_30}' - INTERVAL 20 DAY""")
CHECKS["recommendations_read"] = with_views("""
SELECT user_id, generated_at, 'views' AS algorithm, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, movie_id) - 1 AS INTEGER) AS position,
       movie_id, CAST(n AS DOUBLE) AS score, 'viewed' AS reason
FROM (SELECT *, max(generated_at) OVER (PARTITION BY user_id) AS newest FROM (
  SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 20 HOUR AS generated_at, movie_id, count(*) AS n FROM media_events
  WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND type = 'page_view' GROUP BY ALL) t
  WHERE generated_at >= TIMESTAMP '2024-01-25 06:00:00' - INTERVAL 1 DAY) u WHERE generated_at = newest""")
CHECKS["viewing_durations"] = with_views("""
SELECT user_id, movie_id, ts AS viewed_at, CASE WHEN event_id % 4 <> 0 THEN CAST(((event_id % 10000) * 37) // 1000 AS INTEGER) END AS duration_seconds
FROM media_events WHERE type = 'page_view' AND user_id IS NOT NULL AND movie_id IS NOT NULL""")
_RAW_OK = "event_type IN " + _EVENT_TYPES.replace("'view', ", "")
CHECKS["routed_events"] = f"""
SELECT * FROM (
  SELECT 'input' AS measure, count(*) AS n FROM events
  UNION ALL SELECT 'accepted', count(*) FROM events WHERE {_RAW_OK}
  UNION ALL SELECT 'rejected', count(*) FROM events WHERE NOT ({_RAW_OK})
  UNION ALL SELECT 'type not allowed', count(*) FROM events WHERE NOT ({_RAW_OK})) t WHERE n > 0
UNION ALL SELECT 'written accepted', count(*) FROM events WHERE {_RAW_OK}"""
CHECKS["deliveries_once"] = with_views("SELECT event_id, ts, type FROM media_events")
