"""Load, validation and maintenance jobs over the catalogue (N-*, V-*, W-*, R-*).

Each job composes the operators over staging rows derived from the driver tables
(``cinemetric.sources.staging``) and returns a DataFrame; they are what a nightly load or a
batch of admin edits runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric.operators import arrays as R
from cinemetric.operators import mutate as W
from cinemetric.operators import normalize as N
from cinemetric.operators import validate as V
from cinemetric.sources import ingest as I
from cinemetric.sources import staging as ST

# -- N: normalisation ---------------------------------------------------------------------


def parsed_movies(cat) -> DataFrame:
    """S-01 parse of the movies file rows (C-01, C-04, C-05, C-08, C-11)."""
    return I.parse_movie_rows(ST.movie_file_rows(cat))


def genre_dimension(cat) -> DataFrame:
    """N-01: genres of the movies file, ids in name order."""
    return N.dimension_from_lists(parsed_movies(cat), "genres", "genre_id", "genre_name")


def movie_genre_bridge(cat) -> DataFrame:
    """N-02: (movie, genre) pairs with the N-01 ids."""
    movies = parsed_movies(cat)
    dim = N.dimension_from_lists(movies, "genres", "genre_id", "genre_name")
    return N.bridge_from_lists(movies, "movie_id", "genres", dim, "genre_id", "genre_name")


def company_dimension(cat) -> DataFrame:
    """N-03."""
    return N.dimension_from_lists(parsed_movies(cat), "production_companies", "company_id", "name")


def ratings_upsert(cat) -> DataFrame:
    """N-10 over every rating row: last rating, first created_at."""
    return N.upsert_ratings(ST.rating_rows(cat), ST.LINE_SEQ)


def cast_first_wins(cat) -> DataFrame:
    """N-07."""
    return N.first_credit(ST.cast_rows(cat), ["movie_id", "person_id"], ST.LINE_SEQ, ["character", "cast_order", "credit_id"])


def crew_first_wins(cat) -> DataFrame:
    """N-08."""
    return N.first_credit(ST.crew_rows(cat), ["movie_id", "person_id", "job"], ST.LINE_SEQ, ["department"])


def people_upsert(cat) -> DataFrame:
    """N-05/N-06."""
    return N.upsert_people(ST.people_rows(cat), ST.LINE_SEQ)


def people_id_audit(cat) -> DataFrame:
    """Surrogate ids are dense and unique: people, distinct ids and the largest id agree."""
    return people_upsert(cat).agg(
        F.count(F.lit(1)).alias("people"), F.count_distinct("person_id").alias("ids"), F.max("person_id").alias("max_id")
    )


def users_with_synthetic(cat) -> DataFrame:
    """N-11: profile users are the existing accounts; other raters become synthetic users."""
    existing = cat.user_profiles.select("user_id").withColumn("is_synthetic", F.lit(False))
    return N.synthetic_users(cat.ratings, existing)


def remapped_ratings(cat) -> DataFrame:
    """N-12."""
    links = ST.links(cat)
    return N.remap_rating_ids(ST.small_ratings(cat), links.select("movieId", F.col("tmdbId")))


def movie_documents_loaded(cat) -> DataFrame:
    """S-05 / N-14: movie document rows parsed by name (C-02 JSON first, literal second;
    C-05..C-07 tolerant numbers and bools)."""
    return I.parse_movie_documents(ST.movie_document_rows(cat))


def credit_documents_loaded(cat) -> DataFrame:
    """S-06: credits documents parsed from their text lists."""
    return I.parse_credit_documents(ST.credit_document_rows(cat))


def keywords_loaded(cat) -> DataFrame:
    """S-02: keyword rows parsed into (movie, keyword list)."""
    return I.parse_keyword_rows(ST.keyword_rows(cat))


def remap_audit(cat) -> DataFrame:
    """A-18 for N-12: original / merged / lost rating counts of the id remap."""
    return N.remap_counts(ST.small_ratings(cat), remapped_ratings(cat))


# -- V: validation ---------------------------------------------------------------------------


def checked_rating_rows(cat) -> DataFrame:
    """V-01 on raw rating rows: value rules, UNIQUE(user, movie) (first row in source order
    holds the key) and the movie foreign key."""
    rows = ST.rating_rows(cat)
    rows = V.flag_duplicates(rows, ["user_id", "movie_id"], ST.LINE_SEQ, "_dup")
    rows = V.flag_missing_parent(rows, ["movie_id"], cat.movies, ["movie_id"], "_no_movie")
    rules = V.rating_rules() + [V.flagged("_dup", "duplicate (user_id, movie_id)"), V.flagged("_no_movie", "unknown movie_id")]
    return V.check(rows, rules).drop("_dup", "_no_movie")


def checked_raw_events(cat) -> DataFrame:
    """V-02 on the raw event feed (its type names are not all in the declared enum)."""
    ev = cat.tables.events.select(
        "event_id", F.col("event_type").alias("type"), "ts", F.col("user_id").cast("string").alias("user_id"),
        F.regexp_extract("props", "[0-9]+", 0).alias("movie_id"),
    )
    return V.check(ev, V.event_rules())


def event_check_summary(cat) -> DataFrame:
    chk = checked_raw_events(cat)
    return chk.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))


def retained_events(cat, as_of) -> DataFrame:
    """V-03: events younger than the 30-day TTL at ``as_of``."""
    return V.retain(cat.media_events, "ts", as_of, V.TTL_SECONDS["events"])


def credit_load_audit(cat) -> DataFrame:
    """A-18 / N-13: credit file rows accepted and rejected (no movie id)."""
    rows = ST.cast_rows(cat).select(
        F.when(F.col("cast_order") == 0, F.lit(None)).otherwise(F.col("movie_id").cast("string")).alias("id"),
        F.lit("[]").alias("cast"), F.lit("[]").alias("crew"), F.lit(0).cast("long").alias("seq"),
    )
    ok, bad = I.parse_credit_rows(rows)
    return N.load_counts(ok, bad, "credits")


# -- W: batch mutations ----------------------------------------------------------------------


def ratings_after_upsert(cat) -> DataFrame:
    """W-02: all line-6 rating rows, repeated keys included, upserted into the ratings table."""
    cur = cat.ratings.select("user_id", "movie_id", "rating")
    return W.upsert(cur, ST.rating_rows(cat, 6), ["user_id", "movie_id"], ST.LINE_SEQ)


def facts_after_rating_batch(cat) -> DataFrame:
    """W-02 + fact maintenance: upsert the rating batch, then refresh the per-movie facts of
    the movies the batch touched only."""
    from cinemetric.plans.common import facts_of, refresh_facts

    changes = ST.rating_changes(cat).select("user_id", "movie_id", "rating")
    ratings = W.upsert(cat.ratings.select("user_id", "movie_id", "rating"), changes, ["user_id", "movie_id"], "rating")
    named = cat.movie_genres.join(cat.genres, "genre_id").select("movie_id", "genre_name")
    return refresh_facts(facts_of(cat), ratings, named, changes)


def ratings_strict_insert(cat, as_of) -> DataFrame:
    """W-03: the same batch as strict inserts; existing pairs are refused."""
    cur = cat.ratings.select("user_id", "movie_id", "rating", "created_at")
    batch = ST.rating_changes(cat).select("user_id", "movie_id", "rating")
    _, outcome = W.strict_insert(cur, batch, ["user_id", "movie_id"], "rating", as_of, ["created_at"])
    return outcome.select("user_id", "movie_id", "outcome")


def genres_insert_new(cat) -> DataFrame:
    """W-01: part-type words offered as genres; new names get ids after the current max."""
    cur = cat.genres
    words = cat.tables.part.select(F.upper(F.regexp_extract("p_type", "^[A-Za-z]+", 0)).alias("genre_name")).distinct()
    fresh = words.join(cur.select("genre_name"), "genre_name", "left_anti")
    from cinemetric.operators.keys import ordered_index

    top = cur.select(F.max("genre_id")).scalar()  # scalar sub-query, evaluated once
    numbered = ordered_index(fresh, ["genre_name"], "_rank").select(
        (top + F.col("_rank")).cast("int").alias("genre_id"), "genre_name"
    )
    table, _ = W.insert_if_absent(cur, numbered, ["genre_id"], "genre_name")
    return table


def cascade_counts(cat) -> DataFrame:
    """W-06: delete every movie without a popularity; rows left in each child table."""
    keys = cat.movies.filter(F.col("popularity").isNull()).select("movie_id")
    tables = {
        "ratings": cat.ratings, "movie_genres": cat.movie_genres,
        "movie_production_companies": cat.movie_production_companies, "movie_keywords": cat.movie_keywords,
        "movie_cast": cat.movie_cast, "movie_crew": cat.movie_crew, "movies": cat.movies,
    }
    after = W.cascade_delete(tables, keys, "movie_id")
    out = None
    for name, df in after.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def companies_guarded_delete(cat, name_text: str) -> DataFrame:
    """W-08: request deletion of every company whose name matches; referenced ones are
    refused with their reference count."""
    req = cat.production_companies.filter(F.col("name").ilike(f"%{name_text}%")).select("company_id")
    _, outcome = W.guarded_delete(cat.production_companies, req, "company_id", [cat.movie_production_companies])
    return outcome


def movies_partial_update(cat, as_of, title_text: str) -> DataFrame:
    """W-04: runtime doubled for movies whose title matches; only that field changes."""
    cur = cat.movies.select("movie_id", "title", "runtime", "popularity").withColumn(
        "updated_at", F.lit(None).cast("timestamp_ntz")
    )
    ch = cat.movies.filter(F.col("title").ilike(f"%{title_text}%")).select(
        "movie_id", (F.col("runtime") * 2).alias("runtime")
    )
    return W.partial_update(cur, ch, ["movie_id"], ["runtime"], as_of, "updated_at")


def cast_fk_insert(cat) -> DataFrame:
    """W-09: credit rows offered for insert; unknown movies (ids past the catalogue) refused."""
    movies = cat.movies.filter(F.col("popularity").isNotNull()).select("movie_id")
    cur = cat.movie_cast.limit(0).select("movie_id", "person_id", "character", "cast_order")
    batch = cat.movie_cast.select("movie_id", "person_id", "character", "cast_order")
    _, outcome = W.fk_checked_insert(cur, batch, "movie_id", movies, "movie_id")
    return outcome.select("movie_id", "person_id", "outcome")


# -- R: embedded arrays ----------------------------------------------------------------------


def _genre_text(arr) -> F.Column:
    return F.coalesce(F.array_join(F.transform(arr, lambda x: F.concat(x["id"].cast("string"), F.lit(":"), x["name"])), ", "), F.lit(""))


def documents_genre_append(cat, gid: int, name: str) -> DataFrame:
    """R-04: add genre {gid, name} to every movie document lacking it."""
    d = cat.movie_documents
    elem = F.struct(F.lit(gid).cast("long").alias("id"), F.lit(name).alias("name"))
    return d.select(F.col("id").alias("movie_id"), _genre_text(R.append_if_absent("genres", elem, R.by_fields(id=gid))).alias("genres"))


def documents_genre_rename(cat, gid: int, name: str) -> DataFrame:
    """R-05: rename genre ``gid`` in every document (all matches)."""
    d = cat.movie_documents
    upd = R.update_all("genres", R.by_fields(id=gid), lambda x: x.withField("name", F.lit(name)))
    return d.select(F.col("id").alias("movie_id"), _genre_text(upd).alias("genres"))


def documents_genre_remove(cat, gid: int) -> DataFrame:
    """R-06."""
    d = cat.movie_documents
    return d.select(F.col("id").alias("movie_id"), _genre_text(R.remove_matching("genres", R.by_fields(id=gid))).alias("genres"))


def documents_first_company(cat, name_text: str) -> DataFrame:
    """R-07: the first embedded company whose name contains the text, per document."""
    d = cat.movie_documents
    hit = R.first_matching("production_companies", lambda x: x["name"].contains(name_text))
    return d.select(F.col("id").alias("movie_id"), hit["id"].alias("company_id"), hit["name"].alias("company_name"))
