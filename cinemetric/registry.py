"""Named queries of the library, each a function of a catalogue.

Every entry takes a catalogue (``Catalogue`` over raw tables or ``StoredCatalogue`` over
materialised ones) and returns a lazy DataFrame; parameters are the fixed terms of
``cinemetric.oracle_sql`` so each has an oracle statement with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetric import oracle_sql as O
from cinemetric.plans import credit_load as CL
from cinemetric.plans import document_checks as DK
from cinemetric.plans import documents as D
from cinemetric.plans import event_states as ES
from cinemetric.plans import events as E
from cinemetric.plans import file_jobs as FJ
from cinemetric.plans import loads as L
from cinemetric.plans import lookups as LU
from cinemetric.plans import probes as P
from cinemetric.plans import schema_checks as K
from cinemetric.plans import search as S
from cinemetric.plans import table_jobs as TJ
from cinemetric.plans import upkeep as U

Query = Callable[[object], DataFrame]


def search_queries() -> dict[str, Query]:
    t = O
    return {
        "movie_full_details": lambda c: S.details_as_text(S.movie_full_details(c)),
        "title_search": lambda c: S.title_search(c, t.TITLE),
        "genre_search": lambda c: S.genre_search(c, t.GENRE),
        "company_search": lambda c: S.company_search(c, t.COMPANY),
        "date_range_search": lambda c: S.date_range_search(c, f"{t.YEARS[0]}-01-01", f"{t.YEARS[1]}-12-31"),
        "min_rating_search": lambda c: S.min_rating_search(c, t.MIN_RATING),
        "actor_search": lambda c: S.actor_search(c, t.ACTOR),
        "crew_search": lambda c: S.crew_search(c, t.ACTOR),
        "crew_search_job": lambda c: S.crew_search(c, "Customer#0000001", job="1-URGENT"),
        "keyword_search": lambda c: S.keyword_search(c, t.KEYWORD),
        "keyword_search_all": lambda c: S.keyword_search(c, t.KEYWORD, limit=None),
        "combined_search_rating": lambda c: S.combined_search(
            c, genre=t.GENRE, year_start=t.YEARS[0], year_end=t.YEARS[1], sort_by="rating"
        ),
        "combined_search_actor": lambda c: S.combined_search(c, actor=t.ACTOR, title=t.TITLE),
        "combined_search_all": lambda c: S.combined_search(c),
        "ratings_browse_excellent": lambda c: S.ratings_browse(c, "excellent", "rating_desc"),
        "ratings_browse_high_by_title": lambda c: S.ratings_browse(c, "high", "title"),
        "ratings_browse_low_by_date": lambda c: S.ratings_browse(c, "low", "release_date"),
        "ratings_browse_count_medium": lambda c: S.ratings_browse_count(c, "medium"),
        "ratings_browse_user": lambda c: S.ratings_browse(c, "all", "rating_desc", user_id=t.USER_ID),
        "ratings_browse_popularity": lambda c: S.ratings_browse(c, "all", "popularity_desc"),
        "ratings_browse_random": lambda c: S.ratings_browse(c, "all", "random"),
        "titles_found": lambda c: LU.titles_found(c, t.TITLE),
        "people_found": lambda c: LU.people_found(c, t.ACTOR),
        "movies_found": lambda c: LU.movies_found(c, t.TITLE, limit=None),
        "genre_classes": lambda c: LU.class_rows(c, "genre_id", "genre_name"),
        "company_classes": lambda c: LU.class_rows(c, "company_id", "name"),
        "company_siblings_requested": LU.company_siblings_requested,
        "name_search_movies": lambda c: S.name_search(c.movies.select("movie_id", "title"), "movie_id", "title", t.TITLE, limit=None),
        "name_search_people": lambda c: S.name_search(c.people, "person_id", "name", t.ACTOR),
        "list_companies": lambda c: S.list_dimension(c.production_companies, "company_id", "name"),
        "list_ratings": lambda c: S.list_dimension(c.ratings.select("rating_id", "user_id", "movie_id", "rating"), "rating_id", "rating_id"),
        "list_links_genres": lambda c: S.list_links(c.movie_genres),
        "list_links_companies": lambda c: S.list_links(c.movie_production_companies),
        "list_links_crew": lambda c: S.list_links(c.movie_crew),
        "ratings_browse_medium_rating_asc": lambda c: S.ratings_browse(c, "medium", "rating_asc"),
        "genre_movies": lambda c: S.genre_movies(c, t.GENRE_ID),
        "genre_movies_text": lambda c: S.genre_movies(c, t.GENRE_ID, t.TITLE),
        "genre_movie_counts": lambda c: S.genre_movie_counts(c),
        "company_top_movies": lambda c: S.company_top_movies(c, t.COMPANY_ID),
        "company_movies_recent": lambda c: S.company_movies_recent(c, t.COMPANY_ID),
        "company_profiles": lambda c: S.company_profiles(c).select(
            "company_id", "name", "movie_count", F.array_join("sample_movies", " | ").alias("sample_titles")
        ),
        "movie_genre_list": lambda c: S.movie_genre_list(c, genre_id=t.GENRE_ID),
        "movie_company_list": lambda c: S.movie_company_list(c),
        "sibling_genres": lambda c: S.siblings_as_text(S.sibling_genres(c), "other_genres"),
        "sibling_companies": lambda c: S.sibling_companies(c, t.MOVIE_ID, t.COMPANY_ID),
        "person_credit_counts": lambda c: S.person_credit_counts(c),
        "person_cast_roles": lambda c: S.person_cast_roles(c),
        "person_crew_roles": lambda c: S.person_crew_roles(c),
        "cast_search": lambda c: S.cast_list(c, t.TITLE),
        "cast_list_by_person": lambda c: S.cast_list_by_key(c, person_id=t.PERSON_ID),
        "crew_search_list": lambda c: S.crew_list(c, t.TITLE),
        "crew_list_by_movie": lambda c: S.crew_list_by_key(c, movie_id=t.MOVIE_ID),
        "ratings_list_high_by_rating": lambda c: S.ratings_list(c, tier="high", sort_by="rating_desc"),
        "ratings_list_user": lambda c: S.ratings_list(c, user_id=t.USER_ID),
        "ratings_list_low_created_asc": lambda c: S.ratings_list(c, tier="low", sort_by="created_asc"),
        "ratings_list_by_movie_id": lambda c: S.ratings_list(c, sort_by="movie_id"),
        "ratings_list_counts": lambda c: S.ratings_list_counts(c, tier="excellent"),
        "movie_find": lambda c: S.movie_find(c, t.TITLE),
        "movie_find_by_id": lambda c: S.movie_find(c, "1234"),
        "autocomplete_movies": lambda c: S.autocomplete_movies(c, t.TITLE),
        "autocomplete_people": lambda c: S.autocomplete_people(c, "r#00000001"),
        "name_search_genres": lambda c: S.name_search(c.genres, "genre_id", "genre_name", t.GENRE),
        "name_search_companies": lambda c: S.name_search(c.production_companies, "company_id", "name", "r#0000000"),
        "list_genres": lambda c: S.list_dimension(c.genres, "genre_id", "genre_name"),
        "list_people_page": lambda c: S.list_dimension(c.people, "person_id", "name", limit=50, offset=50),
        "list_links_cast": lambda c: S.list_links(c.movie_cast, t.MOVIE_ID),
        "movie_genre_names": lambda c: S.movie_genre_names(c),
        "deep_fetch": lambda c: S.deep_fetch_as_text(S.deep_fetch(c)),
        # batch forms of the per-key drill-downs (every genre / company / user / credit)
        "genre_movies_all": lambda c: S.genre_movies_all(c),
        "genre_movies_text_all": lambda c: S.genre_movies_all(c, t.TITLE),
        "company_top_movies_all": lambda c: S.company_top_movies_all(c),
        "company_movies_recent_all": lambda c: S.company_movies_recent_all(c),
        "sibling_companies_all": lambda c: S.siblings_as_text(S.sibling_companies_all(c), "other_companies"),
        "ratings_latest_per_user": lambda c: S.ratings_latest_per_user(c),
        "cast_list_all_keys": lambda c: S.cast_list_by_key(c),
        "crew_list_all_keys": lambda c: S.crew_list_by_key(c),
        "list_links_cast_all": lambda c: S.list_links(c.movie_cast),
        "movie_genre_list_all": lambda c: S.movie_genre_list(c, limit=None),
    }


def event_queries() -> dict[str, Query]:
    a7, a30 = O.AS_OF_7, O.AS_OF_30
    return {
        "event_funnel": lambda c: E.event_funnel(c.media_events, a30),
        "top_movies_by_views": lambda c: E.top_movies_by_views(c.media_events),
        "hourly_activity": lambda c: E.hourly_activity(c.media_events, a7),
        "user_engagement": lambda c: E.user_engagement(c.media_events, c.user_profiles, a30),
        "facet_by_type": lambda c: E.facets(c.media_events, a30)["by_type"],
        "facet_by_day_of_week": lambda c: E.facets(c.media_events, a30)["by_day_of_week"],
        "facet_top_movies": lambda c: E.facets(c.media_events, a30)["top_movies"],
        "facet_summary": lambda c: E.facets(c.media_events, a30)["summary"],
        "facet_counts": lambda c: E.facet_counts(c.media_events, a30),
        "conversion_funnel": lambda c: E.conversion_funnel(c.media_events, a30),
        "trending": lambda c: E.trending(c.media_events, a7),
        "trending_scores": lambda c: E.trending_scores(c.media_events, a7),
        "movie_view_buckets_hourly": lambda c: E.movie_view_buckets(c.media_events, "hour"),
        "movie_view_buckets_daily": lambda c: E.movie_view_buckets(c.media_events, "day"),
        "movie_engagement": lambda c: E.movie_engagement(c.media_events, a7),
        "trending_from_states": lambda c: ES.trending_from_states(c, a7),
        "movie_aggregate_documents": lambda c: ES.movie_aggregate_documents(c, a7),
        "view_counts_from_states": ES.view_counts_from_states,
        "sessions": lambda c: E.sessions(c.media_events),
        "activity_summary": lambda c: E.activity_summary(c.media_events),
        "viewing_history": lambda c: E.viewing_history(c.media_events),
    }


def document_queries() -> dict[str, Query]:
    t = O

    def combined(c, **kw):
        return D.combined_search(c.movie_documents, c.credit_documents, c.rating_documents, **kw)

    return {
        "doc_combined_search_rating": lambda c: combined(
            c, genre=t.GENRE, year_start=t.YEARS[0], year_end=t.YEARS[1], sort_by="rating"
        ),
        "doc_combined_search_actor": lambda c: combined(c, actor=t.ACTOR, title=t.TITLE),
        "doc_combined_search_all": lambda c: combined(c),
        "doc_ratings_list": lambda c: D.ratings_list(c.rating_documents, tier="high", sort_by="rating_desc"),
        "doc_ratings_list_low": lambda c: D.ratings_list(c.rating_documents, tier="low"),
        "doc_ratings_list_counts": lambda c: D.ratings_list_counts(c.rating_documents, tier="excellent"),
        "doc_distinct_genres": lambda c: D.distinct_genres(c.movie_documents),
        "doc_distinct_companies": lambda c: D.distinct_companies(c.movie_documents, "r#0000000"),
        "doc_genre_movies": lambda c: D.genre_movies(c.movie_documents, t.GENRE_ID),
        "doc_genre_movie_count": lambda c: D.genre_movie_count(c.movie_documents, str(t.GENRE_ID)),
        "doc_company_movies": lambda c: D.company_movies(c.movie_documents, t.COMPANY_ID),
        "doc_cast_list": lambda c: D.cast_list(c.movie_documents, c.credit_documents, t.TITLE),
        "doc_crew_list": lambda c: D.crew_list(c.movie_documents, c.credit_documents, "high"),
        "doc_movie_details": lambda c: D.movie_details_as_text(D.movie_details(c.movie_documents, c.credit_documents)),
        "doc_movies_by_genre_name": lambda c: D.movies_by_genre_name(c.movie_documents, t.GENRE),
        "doc_popular_movies": lambda c: D.popular_movies(c.movie_documents),
        "doc_movies_page": lambda c: D.movies_page(c.movie_documents, 20, 20),
        "doc_genre_names": lambda c: D.genre_names_of(c.movie_documents),
        "doc_genre_movies_all": lambda c: D.genre_movies_all(c.movie_documents),
        "doc_genre_movie_counts": lambda c: D.genre_movie_counts(c.movie_documents),
        "doc_company_movies_all": lambda c: D.company_movies_all(c.movie_documents),
    }


def load_queries() -> dict[str, Query]:
    t = O

    def parsed(c):
        m = L.parsed_movies(c)
        return m.select(
            "movie_id", "title", "adult", F.col("popularity").cast("double").alias("popularity"), "released_date",
            "runtime", F.size("genres").alias("genre_count"), F.size("production_companies").alias("company_count"),
        )

    def checked(c):
        return L.checked_rating_rows(c).select(
            "user_id", "movie_id", "rating", "created_at", "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice",
            F.array_join("reasons", "; ").alias("reasons"),
        )

    return {
        "ingest_movies_parsed": parsed,
        "ingest_genre_dimension": L.genre_dimension,
        "ingest_movie_documents": lambda c: L.movie_documents_loaded(c).select(
            F.col("id").cast("int").alias("id"), "title", "adult", "popularity", "runtime",
            F.coalesce(F.array_join(F.transform("genres", lambda x: F.coalesce(x["name"], F.lit(""))), ", "),
                       F.lit("")).alias("genre_names"),
            F.coalesce(F.array_join(F.transform("production_companies", lambda x: F.coalesce(x["name"], F.lit(""))),
                                    ", "), F.lit("")).alias("company_names"),
            "genres_raw",
        ),
        "ingest_credit_documents": lambda c: L.credit_documents_loaded(c).select(
            F.col("id").cast("int").alias("id"),
            F.array_join(F.transform("cast", lambda x: F.coalesce(x["name"], F.lit(""))), ", ").alias("cast_names"),
            F.size("crew").alias("crew_count"),
            F.array_join(F.transform("cast", lambda x: x["character"]), ", ").alias("characters"),
        ),
        "ingest_keywords": lambda c: L.keywords_loaded(c).select(
            "movie_id", F.array_join(F.transform("keywords", lambda x: x["name"]), ", ").alias("keyword_names")
        ),
        "ingest_movie_genres": L.movie_genre_bridge,
        "ingest_company_dimension": L.company_dimension,
        "ingest_ratings_upsert": L.ratings_upsert,
        "ingest_cast_first_wins": L.cast_first_wins,
        "ingest_crew_first_wins": L.crew_first_wins,
        "ingest_people_upsert": L.people_upsert,
        "people_id_audit": L.people_id_audit,
        "ingest_synthetic_users": L.users_with_synthetic,
        "ingest_rating_id_remap": L.remapped_ratings,
        "rating_remap_audit": L.remap_audit,
        "validate_rating_rows": checked,
        "validate_raw_events": L.event_check_summary,
        "credit_load_counts": CL.credit_load_counts,
        "credit_load_cast": CL.loaded_cast,
        "ingest_people_in_order": CL.people_arrived,
        "ratings_table_upserted": TJ.ratings_table_upserted,
        "ratings_table_inserted": TJ.ratings_table_inserted,
        "ratings_table_deleted": TJ.ratings_table_deleted,
        "movie_cascade_tables": TJ.movie_cascade_tables,
        "movie_document_cascade": TJ.movie_document_cascade,
        "user_cascade_tables": TJ.user_cascade_tables,
        "document_reason_counts": DK.document_reason_counts,
        "rating_change_outcomes": DK.rating_change_outcomes,
        "mixed_cast_lists": DK.mixed_cast_lists,
        "mixed_lists_converted": DK.mixed_lists_converted,
        "numeric_id_documents": DK.numeric_id_documents,
        "nested_preference_genres": DK.nested_preference_genres,
        "schema_reason_counts": K.schema_reason_counts,
        "schema_rejected_credits": K.rejected_credits,
        "events_retained": lambda c: L.retained_events(c, t.AS_OF_30),
        "credit_load_audit": L.credit_load_audit,
        "ratings_after_upsert": L.ratings_after_upsert,
        "facts_after_rating_batch": lambda c: L.facts_after_rating_batch(c).select(
            "movie_id", (F.col("rating_sum").cast("double") / F.nullif("rating_count", F.lit(0))).alias("avg_rating"),
            "rating_count", "genres",
        ),
        "ratings_strict_insert": lambda c: L.ratings_strict_insert(c, t.AS_OF_7),
        "genres_insert_new": L.genres_insert_new,
        "cascade_counts": L.cascade_counts,
        "companies_guarded_delete": lambda c: L.companies_guarded_delete(c, "#0000000"),
        "movies_partial_update": lambda c: L.movies_partial_update(c, t.AS_OF_7, t.TITLE),
        "cast_fk_insert": L.cast_fk_insert,
        "documents_genre_append": lambda c: L.documents_genre_append(c, 99, "ANIMATION"),
        "documents_genre_rename": lambda c: L.documents_genre_rename(c, 2, "RENAMED"),
        "documents_genre_remove": lambda c: L.documents_genre_remove(c, 2),
        "documents_first_company": lambda c: L.documents_first_company(c, "#00000001"),
    }


def upkeep_queries() -> dict[str, Query]:
    a7, a30 = O.AS_OF_7, O.AS_OF_30
    return {
        "movies_from_csv": FJ.movies_from_csv,
        "ratings_from_csv": FJ.ratings_from_csv,
        "keyword_documents_from_csv": FJ.keyword_documents_from_csv,
        "rating_documents_replaced": FJ.rating_documents_replaced,
        "documents_from_json_arrays": FJ.documents_from_json_arrays,
        "links_from_csv": FJ.links_from_csv,
        "pruned_movie_columns": FJ.pruned_movie_columns,
        "movie_embedded_objects": FJ.movie_embedded_objects,
        "presentation": FJ.presentation,
        "cast_order_measures": FJ.cast_order_measures,
        "ingest_movie_companies": U.company_bridge,
        "ingest_keyword_dimension": U.keyword_dimension,
        "ingest_movie_keywords": U.keyword_bridge,
        "ingest_movies_upsert": U.movies_upserted,
        "recent_movies": U.recent_movies,
        "ratings_after_strict_insert": lambda c: U.ratings_after_strict_insert(c, a7),
        "companies_after_guarded_delete": lambda c: U.companies_after_guarded_delete(c, "0"),
        "cast_after_checked_insert": U.cast_after_checked_insert,
        "documents_company_edits": U.documents_company_edits,
        "documents_credit_edits": U.documents_credit_edits,
        "sessions_retained": lambda c: U.sessions_retained(c, a30),
        "recommendations_read": lambda c: U.recommendations_read(c, "2024-01-25 06:00:00"),
        "viewing_durations": U.viewing_durations,
        "routed_events": U.routed_events,
        "deliveries_once": U.deliveries_once,
        "link_page_summary": U.link_page_summary,
    }


def probe_queries() -> dict[str, Query]:
    t = O
    return {
        "probe_title": lambda c: P.probe_title(c, t.TITLE),
        "probe_genre": lambda c: P.probe_genre(c, t.GENRE),
        "probe_year_range": lambda c: P.probe_year_range(c, *t.YEARS),
        "probe_actor": lambda c: P.probe_actor(c, t.ACTOR),
        "probe_combined": lambda c: P.probe_combined(c, t.GENRE, t.ACTOR, *t.YEARS),
        "latency_report": P.latency_report,
        "latency_winners": P.latency_winners,
        "probe_deep_fetch": lambda c: S.deep_fetch_as_text(P.probe_deep_fetch(c)),
    }


#: Jobs that write tables of their own before they return what is in them.
WRITES = frozenset((
    "schema_reason_counts", "schema_rejected_credits", "ratings_table_upserted", "ratings_table_inserted", "ratings_table_deleted",
    "movie_cascade_tables", "movie_document_cascade", "user_cascade_tables", "trending_from_states", "movie_aggregate_documents",
    "view_counts_from_states", "credit_load_counts", "credit_load_cast", "titles_found", "people_found", "movies_found",
    "movies_from_csv", "ratings_from_csv", "keyword_documents_from_csv", "rating_documents_replaced", "documents_from_json_arrays",
    "links_from_csv", "routed_events", "latency_report", "latency_winners",
))


def all_queries() -> dict[str, Query]:
    """Every named query, by name."""
    return {
        **search_queries(), **event_queries(), **document_queries(), **load_queries(), **upkeep_queries(), **probe_queries()
    }
