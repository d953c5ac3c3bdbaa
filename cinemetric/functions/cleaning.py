"""Cleaning and presentation expressions (C-01..C-37), all as Spark ``Column`` builders.

Each function returns a Column so callers apply it inside one ``select`` over a whole table;
everything is a built-in JVM expression except the literal-list fallback (``literals``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinemetric.functions.literals import jsonish_to_json, literal_to_json, only_when


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Element schemas of the catalogue's embedded lists.
NAMED_ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
CAST_ITEM = T.StructType([
    T.StructField("cast_id", T.LongType()), T.StructField("character", T.StringType()),
    T.StructField("credit_id", T.StringType()), T.StructField("gender", T.IntegerType()),
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("order", T.IntegerType()), T.StructField("profile_path", T.StringType()),
])
CREW_ITEM = T.StructType([
    T.StructField("credit_id", T.StringType()), T.StructField("department", T.StringType()),
    T.StructField("gender", T.IntegerType()), T.StructField("id", T.LongType()),
    T.StructField("job", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("profile_path", T.StringType()),
])

COUNTRY_ITEM = T.StructType([T.StructField("iso_3166_1", T.StringType()), T.StructField("name", T.StringType())])
LANGUAGE_ITEM = T.StructType([T.StructField("iso_639_1", T.StringType()), T.StructField("name", T.StringType())])


def _empty(schema: T.DataType) -> Column:
    return F.array().cast(T.ArrayType(schema))


def literal_list(c, element: T.DataType = NAMED_ITEM) -> Column:
    """C-01: literal/JSON list text → ``array<element>``.  NULL or blank → ``[]``; text that
    neither parser reads → ``[]``.  ``from_json`` handles the common single-quoted form; the
    Arrow fallback sees only rows it could not read."""
    raw = _c(c)
    schema = T.ArrayType(element)
    blank = raw.isNull() | (F.trim(raw) == "")
    direct = F.from_json(raw, schema)
    fallback = F.from_json(literal_to_json(only_when(~blank & direct.isNull(), raw)), schema)
    return F.when(blank, _empty(element)).otherwise(F.coalesce(direct, fallback, _empty(element)))


def jsonish(c, element: T.DataType = NAMED_ITEM) -> tuple[Column, Column]:
    """C-02: ``(parsed, raw)``.  NaN/''/'none'/'nan' → NULL; JSON first, literal second;
    text that parses as neither keeps its raw string in the second column.

    Lists of quoted texts and numbers that read the same as a Python literal and as single-quoted
    JSON (no escape, no bare word, no inner list) stay in ``from_json``; the Arrow fallback sees
    only the rest."""
    raw = _c(c)
    s = F.trim(raw)
    missing = raw.isNull() | (s == "") | F.lower(s).isin("none", "nan")
    schema = T.ArrayType(element)
    direct = F.from_json(s, schema, {"allowSingleQuotes": "false"})
    plain = s.rlike(r"^\[[^\[\]\\]*\]$") & ~s.rlike(r"\b(null|true|false|NaN|Infinity|INF)\b")
    quoted = F.from_json(only_when(direct.isNull() & plain, s), schema)
    fallback = F.from_json(jsonish_to_json(only_when(~missing & direct.isNull() & quoted.isNull(), s)), schema)
    parsed = F.when(missing, F.lit(None).cast(schema)).otherwise(F.coalesce(direct, quoted, fallback))
    kept_raw = F.when(~missing & parsed.isNull(), s)
    return parsed, kept_raw


def convert_string_lists(df, field: str, raw_field: str, element: T.DataType = NAMED_ITEM):
    """C-03: rows whose list is still text (``raw_field`` set by ``jsonish``) are converted
    in place with the literal-first parser; other rows are untouched.  Returns the converted
    table and a one-row count of converted rows."""
    is_text = F.col(raw_field).isNotNull()
    out = df.withColumn(field, F.when(is_text, literal_list(F.col(raw_field), element)).otherwise(F.col(field))).withColumn(
        raw_field, F.lit(None).cast("string")
    )
    counts = df.agg(F.count_if(is_text).alias("converted"))
    return out, counts


def two_format_date(c) -> Column:
    """C-04: ``yyyy-MM-dd`` then ``dd/MM/yyyy`` (unpadded fields accepted), else NULL."""
    s = F.trim(_c(c))
    return F.coalesce(F.try_to_date(s, "yyyy-M-d"), F.try_to_date(s, "d/M/yyyy"))


def tolerant_int(c) -> Column:
    """C-05: ``int(float(x))`` — truncates, invalid → NULL."""
    d = (F.trim(_c(c).cast("string"))).try_cast(T.DoubleType())
    return F.when(F.isnan(d), F.lit(None)).otherwise((d).try_cast(T.LongType()))


def tolerant_float(c) -> Column:
    """C-06: ``float(x)``, invalid or NaN → NULL."""
    d = (F.trim(_c(c).cast("string"))).try_cast(T.DoubleType())
    return F.when(F.isnan(d), F.lit(None)).otherwise(d)


# Spellings accepted as booleans by the document loader.
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")


def tolerant_bool(c) -> Column:
    """C-07: true/t/1/yes/y → true; false/f/0/no/n → false; else NULL."""
    s = F.lower(F.trim(_c(c).cast("string")))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def strict_bool(c) -> Column:
    """C-08: ``upper(x) = 'TRUE'``; blank/NULL → false."""
    return F.coalesce(F.upper(F.trim(_c(c))) == "TRUE", F.lit(False))


def is_missing(c) -> Column:
    """C-09: NULL or NaN."""
    x = _c(c)
    return x.isNull() | F.isnan(x)


def epoch_to_timestamp(c) -> Column:
    """C-10: epoch seconds (float text) → UTC wall-clock ``timestamp_ntz``, invalid → NULL.
    Built as epoch + interval, so the session time zone plays no part."""
    d = (_c(c).cast("string")).try_cast(T.DoubleType())
    secs = F.when(~F.isnan(d), d).try_cast(T.DecimalType(18, 6))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def to_popularity(c) -> Column:
    """C-11: DECIMAL(10,2) as the relational column stores it."""
    return (_c(c)).try_cast(T.DecimalType(10, 2))


def to_rating(c) -> Column:
    """C-11: DECIMAL(3,1)."""
    return (_c(c)).try_cast(T.DecimalType(3, 1))


def zero_as_null(c) -> Column:
    """C-12."""
    return F.nullif(_c(c).cast("double"), F.lit(0.0))


def null_as_zero(c) -> Column:
    """C-13."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0))


def clean_name(c) -> Column:
    """C-14: trimmed name; blank becomes NULL (and is then rejected by the rules)."""
    s = F.trim(_c(c))
    return F.when(s != "", s)


# Gender codes and their labels.
GENDER_LABELS = ("Unknown", "Female", "Male", "Non-binary")


def gender_code(c) -> Column:
    """C-15: NULL or unknown code → 0."""
    g = (_c(c)).try_cast(T.IntegerType())
    return F.when(g.isin(0, 1, 2, 3), g).otherwise(F.lit(0))


def gender_label(c) -> Column:
    g = gender_code(c)
    out = F.lit(GENDER_LABELS[0])
    for code in range(len(GENDER_LABELS) - 1, 0, -1):
        out = F.when(g == code, F.lit(GENDER_LABELS[code])).otherwise(out)
    return out


def format_date(c) -> Column:
    """C-16: ``yyyy-MM-dd``, NULL → 'N/A'."""
    return F.coalesce(F.date_format(_c(c), "yyyy-MM-dd"), F.lit("N/A"))


def format_datetime(c) -> Column:
    return F.coalesce(F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss"), F.lit("N/A"))


def format_popularity(c) -> Column:
    x = _c(c).cast("double")
    return F.when(x.isNotNull(), F.format_string("%.2f", x)).otherwise(F.lit("N/A"))


def runtime_hours(c) -> Column:
    """C-17: ``round(runtime / 60, 1)``."""
    return F.round(_c(c) / 60.0, 1)


# Display colours of the rating bands (>= 9, >= 7, >= 5, below).
RATING_COLOURS = ("#28a745", "#ffc107", "#fd7e14", "#dc3545")


def rating_band(c) -> Column:
    """C-18: colour of a rating: >= 9, >= 7, >= 5, else."""
    r = _c(c)
    g, y, o, red = RATING_COLOURS
    return F.when(r >= 9, g).when(r >= 7, y).when(r >= 5, o).otherwise(red)


def poster_url(c, prefix: str) -> Column:
    """C-20."""
    return F.concat(F.lit(prefix), _c(c))


def title_fallback(original, title) -> Column:
    """C-21: ``original_title or title or ''``."""
    return F.coalesce(F.nullif(_c(original), F.lit("")), F.nullif(_c(title), F.lit("")), F.lit(""))


def names_joined(arr, sep: str = ", ") -> Column:
    """C-22: names of an embedded list in list order (missing name → '')."""
    return F.array_join(F.transform(_c(arr), lambda x: F.coalesce(x["name"], F.lit(""))), sep)


def same_id(c, key) -> Column:
    """C-23: id equality across int / text representations."""
    return F.trim(_c(c).cast("string")) == F.trim(F.lit(key).cast("string"))


def regex_literal(text: str) -> str:
    """C-24: a term matched literally inside ``rlike``."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def icontains_regex(c, pattern: str) -> Column:
    """F-04: case-insensitive regex match (the term is a regex)."""
    return _c(c).rlike("(?i)" + pattern)


def hour_label(h) -> Column:
    """C-25."""
    h = _c(h)
    return F.concat(h.cast("string"), F.lit(":00-"), (h + 1).cast("string"), F.lit(":00"))


def first_n(arr, n: int) -> Column:
    """C-37."""
    return F.slice(_c(arr), 1, n)


def not_blank(c) -> Column:
    """F-12: present and not ''."""
    return _c(c).isNotNull() & (_c(c) != "")


def contains_any_field(cols: Sequence, text: str) -> Column:
    """F-05: lower-case substring over several fields, OR-ed, NULL as ''."""
    t = text.lower()
    out = None
    for c in cols:
        p = F.lower(F.coalesce(_c(c).cast("string"), F.lit(""))).contains(t)
        out = p if out is None else (out | p)
    return out
