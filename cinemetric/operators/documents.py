"""Document checks compiled from a nested description (V-02, V-04, V-05).

A description says what a value may be: ``Value`` (one of some types, perhaps of an enumeration or
within bounds), ``Fields`` (an object with required and described fields) or ``Items`` (an array whose
items are described).  ``check_documents`` turns it into one boolean expression per rule over a VARIANT
column, with the rule's path in its name (``recommendations[].score must be double``), so a table of
documents is checked in one pass without a shuffle, whatever type a field has in which row.

A type name is built from all that a value nests, so it is read once a value, not once a rule:
every described value and its type name are laid out in columns first (items of an array in one
column of structs), and the rules look at those.

A field that is absent breaks only "is required"; one that holds null is there, and must allow null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinemetric.functions import variants as VT
from cinemetric.operators.validate import Rule, check


@dataclass(frozen=True)
class Value:
    types: tuple[str, ...]
    allowed: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Items:
    item: Value | Fields | Items | None = None
    types: tuple[str, ...] = ("array",)


@dataclass(frozen=True)
class Fields:
    required: tuple[str, ...] = ()
    fields: Mapping[str, Value | Fields | Items] = field(default_factory=dict)
    types: tuple[str, ...] = ("object",)


Description = Value | Fields | Items


@dataclass(frozen=True)
class _Seen:
    """A described value as the rules see it: itself, its type name, its described and required
    fields, and its items (an array of what ``_laid_out`` makes of each)."""

    value: Column
    type: Column
    fields: Mapping[str, _Seen]
    items: Column | None = None


def _names(what: Fields) -> list[str]:
    return list(dict.fromkeys((*what.required, *what.fields)))


def _laid_out(what: Description | None, v: Column) -> Column:
    """A value inside an array, with all that its rules look at, as a struct."""
    parts = [v.alias("v"), VT.type_name(v).alias("t")]
    if isinstance(what, Fields):
        parts += [_laid_out(what.fields.get(name), VT.at(v, name)).alias(f"f{i}") for i, name in enumerate(_names(what))]
    elif isinstance(what, Items) and what.item is not None:
        parts.append(_laid_out_items(what, v).alias("items"))
    return F.struct(*parts)


def _laid_out_items(what: Items, v: Column) -> Column:
    return F.transform(VT.items(v), lambda x: _laid_out(what.item, x))


def _seen(what: Description | None, laid: Column) -> _Seen:
    fields = {n: _seen(what.fields.get(n), laid[f"f{i}"]) for i, n in enumerate(_names(what))} if isinstance(what, Fields) else {}
    return _Seen(laid["v"], laid["t"], fields, laid["items"] if isinstance(what, Items) and what.item is not None else None)


def _broken(what: Description, path: str, seen: _Seen) -> list[tuple[str, Column]]:
    """(name, violated) of a value that is there."""
    v, t = seen.value, seen.type
    out: list[tuple[str, Column]] = [(f"{path} must be {' or '.join(what.types)}", ~VT.kind(v, *what.types, known=t))]
    if isinstance(what, Value):
        if what.allowed:
            out.append((f"{path} not allowed", VT.kind(v, "string", known=t) & ~F.try_variant_get(v, "$", "string").isin(*what.allowed)))
        number, is_number = F.try_variant_get(v, "$", "double"), t.isin("BIGINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")
        if what.low is not None:
            out.append((f"{path} below {what.low:g}", is_number & (number < what.low)))
        if what.high is not None:
            out.append((f"{path} above {what.high:g}", is_number & (number > what.high)))
    elif isinstance(what, Fields):
        is_object = t.startswith("OBJECT")
        for name in what.required:
            out.append((f"{_join(path, name)} is required", is_object & seen.fields[name].value.isNull()))
        for name, inner in what.fields.items():
            field_seen = seen.fields[name]
            for said, test in _broken(inner, _join(path, name), field_seen):
                out.append((said, is_object & field_seen.value.isNotNull() & test))
    elif what.item is not None:
        # the names are the same for every item: told from one that is not looked at
        for i, (said, _) in enumerate(_broken(what.item, f"{path}[]", _seen(what.item, F.col("_none")))):
            out.append((said, F.exists(seen.items, _item_test(what.item, i))))
    return out


def _item_test(what: Description, i: int) -> Callable[[Column], Column]:
    """Whether an item breaks the ``i``-th rule of its description."""
    return lambda x: F.coalesce(_broken(what, "", _seen(what, x))[i][1], F.lit(False))


def _join(path: str, name: str) -> str:
    return f"{path}.{name}" if path else name


def _columns(what: Description | None, path: tuple[str, ...]) -> list[tuple[tuple[str, ...], Description | None]]:
    """Paths of the described values that no array holds, the document first."""
    out = [(path, what)]
    if isinstance(what, Fields):
        for name in _names(what):
            out += _columns(what.fields.get(name), (*path, name))
    return out


def check_documents(docs: DataFrame, what: Fields, document: str = "document") -> DataFrame:
    """``docs`` with ``reasons``: the rules of a description that a VARIANT column breaks; a NULL
    document breaks one rule only."""
    nodes = _columns(what, ())
    place = {path: i for i, (path, _) in enumerate(nodes)}
    whole = F.col(document)
    # flat columns, which Spark computes once; extracts of a struct would be put back into every rule
    values = docs.select("*", *[(VT.at(whole, *path) if path else whole).alias(f"_v{i}") for path, i in place.items()])
    listed = [i for i, (_, inner) in enumerate(nodes) if isinstance(inner, Items) and inner.item is not None]
    laid = values.select(
        "*", *[VT.type_name(F.col(f"_v{i}")).alias(f"_t{i}") for i in range(len(nodes))],
        *[_laid_out_items(nodes[i][1], F.col(f"_v{i}")).alias(f"_i{i}") for i in listed],
    )

    def seen(path: tuple[str, ...], inner: Description | None) -> _Seen:
        i = place[path]
        fields = {n: seen((*path, n), inner.fields.get(n)) for n in _names(inner)} if isinstance(inner, Fields) else {}
        return _Seen(F.col(f"_v{i}"), F.col(f"_t{i}"), fields, F.col(f"_i{i}") if i in listed else None)

    top = seen((), what)
    rules = [Rule("document must be object", whole.isNull() | ~top.type.startswith("OBJECT"))]
    rules += [Rule(name, test) for name, test in _broken(what, "", top)[1:]]
    return check(laid, rules).select(*docs.columns, "reasons")


def required_fields(*names: str) -> Fields:
    """V-05: nothing but required fields."""
    return Fields(required=names)


_INT, _TEXT, _DATE, _DOUBLE = Value(("int",)), Value(("string",)), Value(("date",)), Value(("double",))
_INT_OR_NULL, _ANY_OBJECT = Value(("int", "null")), Value(("object",))

# The declared collections.
EVENT_TYPES = (
    "page_view", "search", "click", "add_to_cart", "remove_from_cart", "checkout", "purchase", "rating_submitted",
)
COLLECTIONS: dict[str, Fields] = {
    "events": Fields(
        ("type", "timestamp"),
        {
            "type": Value(("string",), allowed=EVENT_TYPES), "user_id": _INT_OR_NULL, "movie_id": _INT_OR_NULL, "timestamp": _DATE,
            "session_id": _TEXT, "metadata": _ANY_OBJECT, "ip_address": _TEXT, "user_agent": _TEXT,
        },
    ),
    "user_profiles": Fields(
        ("user_id", "last_updated"),
        {
            "user_id": _INT,
            "preferences": Fields(fields={
                "favorite_genres": Items(_TEXT), "favorite_actors": Items(_INT),
                "viewing_history": Items(Fields(fields={"movie_id": _INT, "viewed_at": _DATE, "duration_seconds": _INT})),
                "language_preferences": Items(_TEXT),
            }),
            "recommendations": Items(Fields(fields={"movie_id": _INT, "score": _DOUBLE, "reason": _TEXT})),
            "activity_summary": Fields(fields={
                "total_views": _INT, "total_searches": _INT, "total_ratings": _INT, "total_purchases": _INT, "last_active": _DATE,
            }),
            "last_updated": _DATE,
        },
    ),
    "movie_aggregates": Fields(
        ("movie_id", "computed_at"),
        {
            "movie_id": _INT, "views": Fields(fields={"hourly": _ANY_OBJECT, "daily": _ANY_OBJECT, "total": _INT}),
            "engagement": Fields(fields={"click_rate": _DOUBLE, "add_to_cart_rate": _DOUBLE, "conversion_rate": _DOUBLE}),
            "trending_score": _DOUBLE, "computed_at": _DATE,
        },
    ),
    "sessions": Fields(
        ("session_id", "started_at"),
        {
            "session_id": _TEXT, "user_id": _INT_OR_NULL, "started_at": _DATE, "ended_at": Value(("date", "null")),
            "duration_seconds": _INT, "page_views": _INT,
            "device_info": Fields(fields={"device_type": _TEXT, "browser": _TEXT, "os": _TEXT}), "referrer": _TEXT,
        },
    ),
    "recommendations": Fields(
        ("user_id", "movies", "generated_at"),
        {
            "user_id": _INT, "movies": Items(Fields(("movie_id", "score"), {"movie_id": _INT, "score": _DOUBLE, "reason": _TEXT})),
            "algorithm": _TEXT, "generated_at": _DATE,
        },
    ),
}
#: Rules of the edit screens (V-04): a rating document's bounds are narrower than the table's.
RATING_CHANGE = Fields(("userId", "movieId", "rating"), {"rating": Value(("int", "double"), low=0, high=5)})
CREW_CHANGE_FIELDS = ("department", "job", "credit_id")
