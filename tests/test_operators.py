"""Keys, validation, mutations and array operators on literal cases (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from cinemetric.operators import arrays as R
from cinemetric.operators import mutate as W
from cinemetric.operators import normalize as N
from cinemetric.operators import validate as V
from cinemetric.operators.keys import first_by, last_by, ordered_index


def test_ordered_index_is_dense_and_ordered(spark):
    names = spark.createDataFrame([(f"n{i:04d}",) for i in range(997)], "name string")
    out = ordered_index(names, ["name"], "id").orderBy("id").collect()
    assert [r.id for r in out] == list(range(1, 998))
    assert [r.name for r in out] == sorted(r.name for r in out)


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 5, "z")], "k int, seq int, v string")
    assert {r.k: r.v for r in last_by(df, ["k"], ["seq"], ["v"]).collect()} == {1: "c", 2: "z"}
    assert {r.k: r.v for r in first_by(df, ["k"], ["seq"], ["v"]).collect()} == {1: "a", 2: "z"}


def test_rating_upsert_keeps_first_created(spark):
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    rows = spark.createDataFrame([(1, 10, 3.0, t1, 1), (1, 10, 4.5, t2, 2)],
                                 "user_id int, movie_id int, rating double, created_at timestamp_ntz, seq int")
    r = N.upsert_ratings(rows, ["seq"]).collect()[0]
    assert r.rating == 4.5 and r.created_at == t1 and r.updated_at == t2


def test_surrogate_ids_are_unique_at_size(spark):
    n = 2_000_000
    rows = spark.range(n).select(
        F.col("id").alias("tmdb_id"), F.concat(F.lit("n"), F.xxhash64("id").cast("string")).alias("name"),
        F.lit(1).alias("gender"), F.lit(None).cast("string").alias("profile_path"), F.col("id").alias("seq"))
    got = N.upsert_people(rows, ["seq"]).agg(
        F.count(F.lit(1)), F.count_distinct("person_id"), F.max("person_id")).first()
    assert tuple(got) == (n, n, n)


def test_upsert_merges_fields(spark):
    cur = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, v int")
    ch = spark.createDataFrame([(2, 21, 1), (2, 22, 2), (3, 30, 3), (None, 9, 4)], "k int, v int, seq int")
    got = sorted((r.k, r.name, r.v) for r in W.upsert(cur, ch, ["k"], "seq").collect())
    assert got == [(1, "a", 10), (2, "b", 22), (3, None, 30)]


def test_people_upsert_null_tmdb(spark):
    rows = spark.createDataFrame(
        [(7, "A", 1, "/a", 1), (7, "A2", 2, "/b", 2), (None, "X", 1, None, 3), (None, "X", 2, None, 4),
         (None, "X", 1, "/p", 5), (None, "Y", 0, "/p", 6), (None, "A2", 0, "/b", 7)],
        "tmdb_id long, name string, gender int, profile_path string, seq int")
    out = {(r.tmdb_id, r.name, r.profile_path): r.gender for r in N.upsert_people(rows, ["seq"]).collect()}
    assert out == {(7, "A2", "/b"): 2, (None, "X", None): 1, (None, "X", "/p"): 1, (None, "Y", "/p"): 0}


def test_rejects(spark):
    movies = spark.createDataFrame([(0, "ok"), (1, "t" * 256), (2, None), (3, "fine")], "movie_id int, title string")
    ok, bad = V.split(movies.withColumn("language", F.lit("en")), V.movie_rules())
    assert [r.movie_id for r in ok.collect()] == [3]
    reasons = {r.movie_id: r.reasons for r in bad.collect()}
    assert reasons[0] == ["movie_id must be > 0"]
    assert reasons[1] == ["title longer than 255"]
    assert reasons[2] == ["title is required"]
    ratings = spark.createDataFrame([(1, 3, 10.1, 1), (1, 99, 5.0, 2), (1, 3, 2.0, 3)],
                                    "user_id int, movie_id int, rating double, seq int")
    r = V.flag_missing_parent(ratings, ["movie_id"], movies, ["movie_id"], "_fk")
    r = V.flag_duplicates(r, ["user_id", "movie_id"], ["seq"], "_dup")
    rules = V.rating_rules() + [V.flagged("_fk", "unknown movie"), V.flagged("_dup", "duplicate")]
    got = {row.seq: row.reasons for row in V.check(r, rules).collect()}
    assert got == {1: ["rating must be in [0, 10.0]"], 2: ["unknown movie"], 3: ["duplicate"]}


def test_reject_with_children(spark):
    bad = spark.createDataFrame([(1,)], "movie_id int")
    kids = {"cast": spark.createDataFrame([(1, 5), (2, 6)], "movie_id int, person_id int")}
    assert [r.movie_id for r in V.reject_with_children(bad, "movie_id", kids)["cast"].collect()] == [2]


def test_retention_boundary(spark):
    as_of = "2024-02-10 00:00:00"
    ts = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 10, 23, 59, 59), dt.datetime(2024, 1, 11, 0, 0, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, ts timestamp_ntz")
    kept = sorted(r.i for r in V.retain(df, "ts", as_of, 30 * 86400).collect())
    assert kept == [0, 2]


def test_mutations(spark):
    cur = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, v int")
    ch = spark.createDataFrame([(2, "B", 21), (3, "c", 30), (3, "c2", 31)], "k int, name string, v int")
    table, ins = W.insert_if_absent(cur, ch, ["k"], "v")
    assert sorted((r.k, r.name) for r in table.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    up = W.upsert(cur, ch.withColumn("seq", F.col("v")), ["k"], seq="seq")
    assert sorted((r.k, r.name) for r in up.collect()) == [(1, "a"), (2, "B"), (3, "c2")]
    _, outcome = W.strict_insert(cur, ch, ["k"], "v")
    assert sorted((r.k, r.outcome) for r in outcome.collect()) == [
        (2, "duplicate key"), (3, "duplicate in batch"), (3, "inserted")]
    part = spark.createDataFrame([(1, None, 99)], "k int, name string, v int")
    upd = {r.k: (r.name, r.v) for r in W.partial_update(cur, part, ["k"], ["name", "v"]).collect()}
    assert upd == {1: ("a", 99), 2: ("b", 20)}
    kept, gone = W.delete_keys(cur, spark.createDataFrame([(2,), (5,)], "k int"), ["k"])
    assert [r.k for r in kept.collect()] == [1] and [r.k for r in gone.collect()] == [2]
    refs = spark.createDataFrame([(1,), (1,)], "k int")
    after, res = W.guarded_delete(cur, spark.createDataFrame([(1,), (2,)], "k int"), "k", [refs])
    assert sorted((r.k, r.outcome, r.ref_count) for r in res.collect()) == [(1, "refused", 2), (2, "deleted", 0)]
    assert [r.k for r in after.collect()] == [1]
    parent = spark.createDataFrame([(1,)], "k int")
    _, fk = W.fk_checked_insert(cur, ch, "k", parent, "k")
    assert {r.outcome for r in fk.collect()} == {"unknown k"}


def test_array_operators(spark):
    schema = "i int, arr array<struct<id:int,name:string,job:string>>"
    data = [
        (1, [(1, "a", "x")]),                      # present
        (2, [(2, "b", "x")]),                      # absent
        (3, [(1, "a", "x"), (1, "a2", "y")]),      # two matching
        (4, None),                                  # null array
        (5, []),                                    # empty array
    ]
    df = spark.createDataFrame(data, schema)
    elem = F.struct(F.lit(1).alias("id"), F.lit("new").alias("name"), F.lit("z").alias("job"))
    is1 = R.by_fields(id=1)
    out = df.select(
        "i",
        R.append_if_absent("arr", elem, is1).alias("app"),
        R.update_all("arr", is1, lambda x: x.withField("name", F.lit("U"))).alias("all"),
        R.update_first("arr", is1, lambda x: x.withField("name", F.lit("U"))).alias("first"),
        R.remove_matching("arr", is1).alias("rm"),
        R.first_matching("arr", is1).alias("get"),
    ).orderBy("i").collect()
    names = lambda a: None if a is None else [e.name for e in a]
    assert [names(r.app) for r in out] == [["a"], ["b", "new"], ["a", "a2"], ["new"], ["new"]]
    assert names(out[2].all) == ["U", "U"] and names(out[2].first) == ["U", "a2"]
    assert names(out[2].rm) == [] and names(out[3].rm) is None and names(out[4].rm) == []
    assert out[2].get.name == "a" and out[1].get is None and out[4].get is None
    crew = spark.createDataFrame([(1, [(1, "a", "x"), (1, "a", "y")])], schema)
    upd = crew.select(R.update_first("arr", R.by_fields(id=1, job="y"), lambda x: x.withField("name", F.lit("Y"))).alias("u"))
    assert names(upd.collect()[0].u) == ["a", "Y"]
    valid = spark.createDataFrame([(1, [(1, "a", None), (None, "b", None), (2, None, None)])], schema)
    assert names(valid.select(R.with_fields("arr", "id", "name").alias("v")).collect()[0].v) == ["a"]


def test_synthetic_users_and_remap(spark):
    ratings = spark.createDataFrame([(1,), (2,), (2,)], "user_id int")
    users = spark.createDataFrame([(1, False)], "user_id int, is_synthetic boolean")
    got = sorted((r.user_id, r.is_synthetic) for r in N.synthetic_users(ratings, users).collect())
    assert got == [(1, False), (2, True)]
    small = spark.createDataFrame([(1, 10, 4.0, 5), (1, 11, 3.0, 6)], "userId int, movieId int, rating double, timestamp long")
    links = spark.createDataFrame([(10, "862.0"), (11, None)], "movieId int, tmdbId string")
    links = links.select("movieId", F.col("tmdbId").cast("double").cast("int").alias("tmdbId"))
    out = N.remap_rating_ids(small, links).collect()
    assert [(r.userId, r.movieId) for r in out] == [(1, 862)]


def test_bad_child_rejects_whole_input_row(spark):
    movies = spark.createDataFrame([(1, "ok"), (2, "fine"), (3, None)], "movie_id int, title string")
    cast = spark.createDataFrame([(1, "c1", "x" * 60), (1, "c2", "y"), (2, "c3", "z")], "movie_id int, name string, credit_id string")
    accepted, rejected = V.reject_input_rows(
        {"movies": (movies.withColumn("language", F.lit("en")), V.movie_rules()), "cast": (cast, [V.max_length("credit_id", 50)])},
        "movie_id",
    )
    assert sorted(r.movie_id for r in accepted["movies"].collect()) == [2]
    assert sorted(r.name for r in accepted["cast"].collect()) == ["c3"]   # c2 is fine but shares movie 1
    got = {r.movie_id: r.reasons for r in rejected.collect()}
    assert got == {1: ["cast: credit_id longer than 50"], 3: ["movies: title is required"]}


def test_hot_key_top_k_and_last_wins(spark):
    from pyspark.sql import Window

    from cinemetric.plans.common import top_k_per_group

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),   # key 0: a third of the rows
        F.col("id"), ((F.col("id") * 7919) % 100003).alias("v"),
    )
    order = [F.col("v").desc(), F.col("id")]
    got = top_k_per_group(df, ["k"], order, 5, ["id"])
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*order))).filter("r <= 5").drop("r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    last = last_by(df, ["k"], ["v", "id"], ["id"])
    want_last = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("id").desc())))
    want_last = want_last.filter("r = 1").select("k", "id")
    assert last.exceptAll(want_last).count() == 0 and want_last.exceptAll(last).count() == 0
