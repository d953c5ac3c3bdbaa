"""Checks and reads of documents whose fields hold mixed types (V-02, V-04, V-05, R-09, C-03, C-35, F-13).

``raw_documents`` writes what the five collections would be offered as JSON text, one document per row
of a driver table, with faults of every kind left in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.functions import variants as VT
from cinemetric.functions.cleaning import CAST_ITEM
from cinemetric.operators import constraints as C
from cinemetric.operators import documents as DOC


def _json(**fields: Column) -> Column:
    """An object from JSON fragments; a NULL fragment is an absent field."""
    parts = [F.concat(F.lit(f'"{name}": '), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _text(c) -> Column:
    return F.concat(F.lit('"'), F.col(c) if isinstance(c, str) else c, F.lit('"'))


def _number(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _date(c: str, form: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    return F.concat(F.lit('{"$date": "'), F.date_format(c, form), F.lit('Z"}'))


def _fault(column: str, n: int, faulty, otherwise: Column) -> Column:
    """Every n-th row has ``faulty`` (a fragment; None: the field is absent)."""
    return F.when(F.col(column) % n == 0, F.lit(faulty).cast("string")).otherwise(otherwise)


def raw_documents(cat) -> dict[str, DataFrame]:
    """``key, body`` of each collection's documents."""
    t = cat.tables
    ev, cu, pa, od = "event_id", "c_custkey", "p_partkey", "o_orderkey"
    events = t.events.select(ev, "ts", "event_type", "user_id").select(
        F.col(ev).cast("long").alias("key"),
        _json(
            type=_fault(ev, 37, None, _text(F.when(F.col("event_type") == "view", "page_view").otherwise(F.col("event_type")))),
            user_id=_fault(ev, 11, "null", _fault(ev, 13, '"u1"', _number("user_id"))),
            movie_id=_fault(ev, 17, "1.5", _number(F.col(ev) % 1000)),
            timestamp=_fault(ev, 19, None, _fault(ev, 23, '"2024-01-01"', _date("ts"))),
            session_id=_fault(ev, 29, "7", _text(_number("user_id"))),
            metadata=_fault(ev, 31, "[1]", F.lit('{"page": {"n": 1}}')),
        ).alias("body"),
    )
    genres = F.when(F.col(cu) % 11 == 0, F.lit('["Drama", 5]')).otherwise(F.concat(F.lit("["), _text("c_mktsegment"), F.lit("]")))
    history = F.concat(
        F.lit('[{"movie_id": '), _number(cu), F.lit(', "viewed_at": {"$date": "2024-01-02T00:00:00Z"}}, {"movie_id": 1, "duration_seconds": '),
        _fault(cu, 13, '"long"', F.lit("60")), F.lit("}]"),
    )
    profiles = t.customer.select(cu, "c_mktsegment").select(
        F.col(cu).cast("long").alias("key"),
        _json(
            user_id=_fault(cu, 7, "3000000000", _number(cu)),
            preferences=_fault(cu, 29, "[]", _json(favorite_genres=genres, favorite_actors=_fault(cu, 17, '{"a": 1}', F.lit("[1, 2]")), viewing_history=history)),
            recommendations=F.concat(F.lit('[{"movie_id": 1, "score": '), _fault(cu, 23, "1", F.lit("0.5")), F.lit("}]")),
            activity_summary=_json(total_views=_fault(cu, 19, "1.0", F.lit("3"))),
            last_updated=_fault(cu, 31, None, F.lit('{"$date": "2024-02-01T10:00:00Z"}')),
        ).alias("body"),
    )
    aggregates = t.part.select(pa, "p_retailprice").select(
        F.col(pa).cast("long").alias("key"),
        _json(
            movie_id=_fault(pa, 29, "null", _number(pa)),
            views=_json(hourly=_fault(pa, 7, "[3]", F.lit('{"h0": 1}')), total=_number(pa)),
            engagement=_fault(pa, 11, '"none"', _json(click_rate=_fault(pa, 13, "1", F.lit("0.25")), conversion_rate=F.lit("1e-2"))),
            trending_score=_number(F.col("p_retailprice").cast("decimal(10,2)")),
            computed_at=_fault(pa, 17, '{"$date": "yesterday"}', F.lit('{"$date": "2024-02-01T10:00:00Z"}')),
        ).alias("body"),
    )
    sessions = t.orders.select(od, "o_orderdate", "o_custkey").select(
        F.col(od).cast("long").alias("key"),
        F.when(F.col(od) % 41 == 0, "no document").when(F.col(od) % 43 == 0, "[1, 2]").otherwise(
            _json(
                session_id=_fault(od, 19, "12", _text(_number(od))), user_id=_fault(od, 7, "null", _number("o_custkey")),
                started_at=_fault(od, 11, "null", _date("o_orderdate", "yyyy-MM-dd'T'00:00:00")), ended_at=_fault(od, 3, "null", _fault(od, 5, "5", _date("o_orderdate", "yyyy-MM-dd'T'00:00:00"))),
                page_views=_fault(od, 13, '"3"', F.lit("3")), device_info=_json(device_type=F.lit('"tv"'), os=_fault(od, 17, "null", F.lit('"x"'))),
            )
        ).alias("body"),
    )
    movies = F.concat(
        F.lit('[{"movie_id": 1, "score": 0.5, "reason": "r"}, {'), F.concat_ws(", ", _fault(cu, 5, None, F.lit('"movie_id": 2')), _fault(cu, 7, None, F.lit('"score": 0.25'))),
        F.lit("}]"),
    )
    recommendations = t.customer.select(cu).select(
        F.col(cu).cast("long").alias("key"),
        _json(
            user_id=_number(cu), movies=_fault(cu, 13, None, _fault(cu, 17, "null", movies)), algorithm=_fault(cu, 19, "1", F.lit('"mean"')),
            generated_at=F.lit('{"$date": "2024-02-01T10:00:00Z"}'),
        ).alias("body"),
    )
    return {"events": events, "user_profiles": profiles, "movie_aggregates": aggregates, "sessions": sessions, "recommendations": recommendations}


def checked_documents(cat) -> dict[str, DataFrame]:
    """V-02: each collection's documents with the rules they break."""
    return {
        name: DOC.check_documents(raw.select("key", VT.parsed("body").alias("document")), DOC.COLLECTIONS[name])
        for name, raw in raw_documents(cat).items()
    }


def document_reason_counts(cat) -> DataFrame:
    return C.reason_counts(checked_documents(cat))


def rating_change_outcomes(cat) -> DataFrame:
    """V-04 / V-05: rating documents offered on the edit screen, with the reasons that refuse them."""
    r = cat.line_orders(6).select("o_custkey", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    body = _json(
        userId=_fault("o_custkey", 13, None, _number("o_custkey")), movieId=_number("l_partkey"),
        rating=_fault("l_partkey", 11, '"5"', _fault("l_partkey", 17, None, _number((F.col("q") - 5).cast("decimal(4,1)") / 4))),
    )
    docs = r.select("o_custkey", "l_partkey", "q", VT.parsed(body).alias("document"))
    checked = DOC.check_documents(docs, DOC.RATING_CHANGE)
    return checked.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))


# -- columns of mixed type ------------------------------------------------------------------


def mixed_credits(cat) -> DataFrame:
    """``id, document``: credit documents whose cast is a list in some rows, JSON or literal text in
    others, absent or no list at all in the rest."""
    c = cat.credit_documents.select("id", F.to_json("cast").alias("cast"))
    quoted = F.to_json(F.struct(F.regexp_replace("cast", '"', "'").alias("x")))
    as_text = F.regexp_extract(F.to_json(F.struct(F.col("cast").alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    as_literal = F.regexp_extract(quoted, r"(?s)^\{\"x\":(.*)\}$", 1)
    cast = F.when(F.col("id") % 4 == 0, as_text).when(F.col("id") % 4 == 1, as_literal).when(F.col("id") % 11 == 0, F.lit("5")).otherwise(F.col("cast"))
    body = _json(id=_fault("id", 5, '"x1"', _number("id")), cast=F.when(F.col("id") % 13 != 0, cast))
    return c.select("id", VT.parsed(body).alias("document"))


def mixed_cast_lists(cat) -> DataFrame:
    """R-09: the cast of every mixed document as a list."""
    rows = mixed_credits(cat).select("id", VT.as_list(VT.at(F.col("document"), "cast"), CAST_ITEM).alias("cast"))
    return rows.select("id", F.size("cast").alias("members"), F.array_join(F.transform("cast", lambda x: x["name"]), ", ").alias("names"))


def mixed_lists_converted(cat) -> DataFrame:
    """C-03: documents whose cast is text, converted in place: how many, and their members."""
    rows = mixed_credits(cat).filter(VT.is_string(VT.at(F.col("document"), "cast")))
    cast = VT.as_list(VT.at(F.col("document"), "cast"), CAST_ITEM)
    return rows.agg(F.count(F.lit(1)).alias("converted"), F.coalesce(F.sum(F.size(cast)), F.lit(0)).alias("members"))


def numeric_id_documents(cat) -> DataFrame:
    """F-13: documents whose id is a number, not the text of one."""
    doc = F.col("document")
    return mixed_credits(cat).filter(VT.is_number(VT.at(doc, "id"))).select(F.try_variant_get(doc, "$.id", "int").alias("id"))


def nested_preference_genres(cat) -> DataFrame:
    """C-35: profiles per favourite genre, read at ``preferences.favorite_genres`` where that is a list of texts."""
    docs = raw_documents(cat)["user_profiles"].select(VT.parsed("body").alias("document"))
    listed = F.try_variant_get(VT.at(F.col("document"), "preferences", "favorite_genres"), "$", "array<variant>")
    rows = docs.select(F.explode(listed).alias("g")).filter(VT.is_string(F.col("g")))
    return rows.groupBy(F.try_variant_get("g", "$", "string").alias("genre")).agg(F.count(F.lit(1)).alias("profiles"))
