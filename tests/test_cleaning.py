"""Literal cases for the cleaning expressions (C-01..C-37)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cinemetric.functions import cleaning as C


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def test_literal_list_cases(spark):
    values = [
        "[{'id': 18, 'name': 'Drama'}]",
        "[{'id': 1, 'name': \"O'Neal\"}]",
        "[{'id': None, 'name': 'x'}]",
        "[{'id': 1, 'v': True}]",
        "[{'id': 2, 'name': 'a\\xa0b'}]",
        "[{'id': 3, 'name': 'trunc",
        "",
        None,
        "nan",
        '[{"id": 5, "name": "Json"}]',
    ]
    df = _one_col(spark, values).select("i", C.literal_list("v").alias("p")).orderBy("i")
    got = [[(e["id"], e["name"]) for e in r.p] for r in df.collect()]
    assert got[0] == [(18, "Drama")]
    assert got[1] == [(1, "O'Neal")]
    assert got[2] == [(None, "x")]          # Python None via the Arrow fallback
    assert got[3] == [(1, None)]            # True is legal Python; 'name' absent
    assert got[4] == [(2, "a\xa0b")]        # \xa0 escape decoded, not turned into 'xa0'
    assert got[5] == []                     # truncated text → []
    assert got[6] == [] and got[7] == []    # blank / NULL → []
    assert got[8] == []                     # not a list
    assert got[9] == [(5, "Json")]


def test_jsonish_keeps_raw(spark):
    df = _one_col(spark, ["[{'id': 1, 'name': 'A'}]", "none", "NaN", "garbage text", None])
    p, raw = C.jsonish("v")
    rows = df.select("i", p.alias("p"), raw.alias("raw")).orderBy("i").collect()
    assert [(e["id"], e["name"]) for e in rows[0].p] == [(1, "A")] and rows[0].raw is None
    assert rows[1].p is None and rows[1].raw is None
    assert rows[2].p is None and rows[2].raw is None
    assert rows[3].p is None and rows[3].raw == "garbage text"
    assert rows[4].p is None and rows[4].raw is None


def test_two_format_date(spark):
    df = _one_col(spark, ["1995-10-30", "30/10/1995", "1995-1-2", "1995-13-01", "", None])
    got = [r.d for r in df.select("i", C.two_format_date("v").alias("d")).orderBy("i").collect()]
    assert got == [dt.date(1995, 10, 30), dt.date(1995, 10, 30), dt.date(1995, 1, 2), None, None, None]


def test_numbers_and_bools(spark):
    df = _one_col(spark, ["12", "12.0", "12.9", "x", "NaN", None])
    rows = df.select("i", C.tolerant_int("v").alias("n"), C.tolerant_float("v").alias("f")).orderBy("i").collect()
    assert [r.n for r in rows] == [12, 12, 12, None, None, None]
    assert [r.f for r in rows] == [12.0, 12.0, 12.9, None, None, None]
    b = _one_col(spark, ["True", "f", "yes", "maybe", " Y ", None])
    got = [r.b for r in b.select("i", C.tolerant_bool("v").alias("b")).orderBy("i").collect()]
    assert got == [True, False, True, None, True, None]
    s = _one_col(spark, ["TRUE", "true", "False", "", None])
    assert [r.b for r in s.select("i", C.strict_bool("v").alias("b")).orderBy("i").collect()] == [True, True, False, False, False]


def test_epoch_rating_popularity(spark):
    df = _one_col(spark, ["0", "86400.5", "bad", None])
    got = [r.t for r in df.select("i", C.epoch_to_timestamp("v").alias("t")).orderBy("i").collect()]
    assert got[0] == dt.datetime(1970, 1, 1) and got[1] == dt.datetime(1970, 1, 2, 0, 0, 0, 500000)
    assert got[2] is None and got[3] is None
    r = _one_col(spark, ["4.25", "10.0", "x"]).select("i", C.to_rating("v").alias("r")).orderBy("i").collect()
    assert [x.r for x in r] == [Decimal("4.3"), Decimal("10.0"), None]


def test_presentation_helpers(spark):
    df = spark.createDataFrame([(1, 0.0, None, 125, 9.5, "", "T"), (2, 3.5, "2020-01-02", None, 4.9, None, None)],
                               "i int, pop double, d string, rt int, r double, orig string, title string")
    rows = df.select(
        "i", C.zero_as_null("pop").alias("z"), C.null_as_zero("pop").alias("nz"),
        C.format_date(F.to_date("d")).alias("fd"), C.runtime_hours("rt").alias("h"), C.rating_band("r").alias("band"),
        C.title_fallback("orig", "title").alias("t"), C.format_popularity("pop").alias("fp"),
    ).orderBy("i").collect()
    assert rows[0].z is None and rows[0].nz == 0.0 and rows[0].fd == "N/A" and rows[0].h == 2.1
    assert rows[0].band == "#28a745" and rows[0].t == "T" and rows[0].fp == "0.00"
    assert rows[1].z == 3.5 and rows[1].fd == "2020-01-02" and rows[1].h is None and rows[1].band == "#dc3545"
    assert rows[1].t == ""


def test_gender_and_ids(spark):
    df = _one_col(spark, ["0", "1", "2", "3", "7", None])
    got = [r.g for r in df.select("i", C.gender_label("v").alias("g")).orderBy("i").collect()]
    assert got == ["Unknown", "Female", "Male", "Non-binary", "Unknown", "Unknown"]
    ids = spark.createDataFrame([(1, "42"), (2, " 42 "), (3, "43")], "i int, v string")
    assert [r.m for r in ids.select("i", C.same_id("v", 42).alias("m")).orderBy("i").collect()] == [True, True, False]


def test_regex_and_contains(spark):
    df = spark.createDataFrame([(1, "Toy Story", None), (2, "toy (story)", "x")], "i int, a string, b string")
    lit = C.regex_literal("toy (story)")
    got = [r.m for r in df.select("i", C.icontains_regex("a", lit).alias("m")).orderBy("i").collect()]
    assert got == [False, True]
    got = [r.m for r in df.select("i", C.contains_any_field(["a", "b"], "NONE").alias("m")).orderBy("i").collect()]
    assert got == [False, False]   # NULL is '' here, not the text 'none'


def test_convert_string_lists_counts(spark):
    df = spark.createDataFrame(
        [(1, "[{'id': 1, 'name': 'A'}]"), (2, '[{"id": 2, "name": "B"}]'), (3, "[{'id': 3, 'name': 'x', 'v': None}]"),
         (4, "broken")], "i int, v string")
    p, raw = C.jsonish("v")
    staged = df.select("i", p.alias("genres"), raw.alias("genres_raw"))
    out, counts = C.convert_string_lists(staged, "genres", "genres_raw")
    got = {r.i: [e.name for e in r.genres] for r in out.collect()}
    assert got == {1: ["A"], 2: ["B"], 3: ["x"], 4: []}
    assert counts.collect()[0].converted == 1   # only row 4 was still text after loading


def test_prune_columns(spark):
    from cinemetric.sources.ingest import prune_columns

    df = spark.createDataFrame([(1, "x", "y", "z")], "id int, homepage string, title string, original_title string")
    assert prune_columns(df).columns == ["id", "original_title"]
