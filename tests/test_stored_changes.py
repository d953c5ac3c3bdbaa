"""Key-range tables, constraint checks and document checks on literal rows."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from cinemetric.functions import variants as VT
from cinemetric.functions.cleaning import NAMED_ITEM
from cinemetric.operators import constraints as C
from cinemetric.operators import documents as DOC
from cinemetric.operators import key_ranges as K
from cinemetric.operators.key_ranges import KeyRangeTable


def _files(path):
    found = glob.glob(f"{path}/data/**/*.parquet", recursive=True)
    return {p: os.stat(p).st_mtime_ns for p in found}


def _state(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_changes_touch_only_their_ranges(spark, tmp_path):
    # one movie holds half of the rows: its ratings span several ranges
    rows = [(1, u, 1.0) for u in range(100)] + [(m, 0, 2.0) for m in range(2, 102)]
    table = KeyRangeTable(spark, str(tmp_path / "t"), ["movie", "user"], target_rows=20)
    table.create(spark.createDataFrame(rows, "movie int, user int, rating double"))
    want = {(m, u): r for m, u, r in rows}
    assert _state(table) == sorted((*k, v) for k, v in want.items())
    before, first = _files(table.path), table._manifest()
    assert len(first) == 10
    batch = [(60, 0, 9.0, 1), (60, 0, 8.0, 2), (60, 5, 7.0, 1), (None, 1, 1.0, 1), (61, None, 1.0, 1)]
    table.upsert(spark.createDataFrame(batch, "movie int, user int, rating double, seq int"), "seq")
    want.update({(60, 0): 8.0, (60, 5): 7.0})
    assert _state(table) == sorted((*k, v) for k, v in want.items())
    after = _files(table.path)
    assert {p: t for p, t in after.items() if p in before} == before
    kept = {e["folder"] for e in first} & {e["folder"] for e in table._manifest()}
    assert len(kept) == len(first) - 1
    assert sorted(map(tuple, table.read(0).collect())) == sorted(rows)  # a reader of the old version

    table.insert_if_absent(spark.createDataFrame([(60, 0, 1.0, 1), (500, 1, 3.0, 2), (500, 1, 4.0, 1), (0, 0, 5.0, 1)], "movie int, user int, rating double, seq int"), "seq")
    want.update({(500, 1): 4.0, (0, 0): 5.0})
    assert _state(table) == sorted((*k, v) for k, v in want.items())
    table.delete(spark.createDataFrame([(1,), (77,), (999,)], "movie int"), ["movie"])
    want = {k: v for k, v in want.items() if k[0] not in (1, 77)}
    assert _state(table) == sorted((*k, v) for k, v in want.items())
    ranges = [(tuple(e["low"]), tuple(e["high"])) for e in table._manifest()]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    with pytest.raises(ValueError):
        table.delete(spark.createDataFrame([(1,)], "user int"), ["user"])


def test_failed_and_concurrent_changes(spark, tmp_path):
    table = KeyRangeTable(spark, str(tmp_path / "t"), ["k"], target_rows=3)
    table.create(spark.createDataFrame([(i, "a") for i in range(9)], "k int, v string"))
    one = spark.createDataFrame([(4, "b", 1)], "k int, v string, seq int")
    with pytest.raises(RuntimeError, match="lost"):
        table.change(one, lambda rows, b: (_ for _ in ()).throw(RuntimeError("lost")))
    # a writer that died after its data and before its commit: no _SUCCESS, no version
    os.makedirs(f"{table.path}/manifest/v=7")
    assert table.versions() == [0] and _state(table) == [(i, "a") for i in range(9)]
    slow = KeyRangeTable(spark, table.path, ["k"], 3)
    seen = slow.versions
    table.upsert(one, "seq")
    slow.versions = lambda: [0]
    with pytest.raises(K.VersionTaken):
        slow.upsert(one, "seq")
    assert seen() == [0, 1] and dict(_state(table))[4] == "b"
    table.delete(spark.createDataFrame([(i,) for i in range(9)], "k int"))
    assert _state(table) == []
    table.upsert(one, "seq")
    assert _state(table) == [(4, "b")]


def test_large_ranges_split_and_merge_over_gaps(spark, tmp_path):
    table = KeyRangeTable(spark, str(tmp_path / "t"), ["k"], target_rows=10)
    table.create(spark.createDataFrame([(i * 100, 0) for i in range(30)], "k int, v int"))
    more = [(i, 1, 1) for i in range(100, 160)] + [(2500, 2, 1)]
    table.upsert(spark.createDataFrame(more, "k int, v int, seq int"), "seq")
    want = {i * 100: 0 for i in range(30)} | {k: v for k, v, _ in more}
    assert _state(table) == sorted(want.items())
    ranges = [(e["low"]["k"], e["high"]["k"], e["n"]) for e in table._manifest()]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and max(r[2] for r in ranges) <= 45


def test_constraints_of_small_tables(spark):
    rules = {
        "p": C.TableRules(("id",), (C.Field("name", True, 3),), (("name",),)),
        "c": C.TableRules(("id",), (C.Field("x", low=0, high=5),), (("a", "b"),), (C.Reference("pid", "p", "id"),)),
    }
    p = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3), (3, None, 4), (None, "z", 5), (4, "long", 6), (4, "d", 7)], "id int, name string, seq int")
    c = spark.createDataFrame(
        [(1, 1, "q", "r", 1.0, 1), (2, 2, "q", "s", 1.0, 2), (3, None, "q", "r", 9.0, 3), (4, 4, "q", "r", 1.0, 4), (4, 4, None, "r", 1.0, 5), (5, 4, None, "r", -1.0, 6)],
        "id int, pid int, a string, b string, x double, seq int",
    )
    assert C.parents_first({"c": rules["c"], "p": rules["p"]}) == ["p", "c"]
    out = C.check_tables({"c": c, "p": p}, rules, {"c": ["seq"], "p": ["seq"]})
    said = lambda n: {r["seq"]: r["reasons"] for r in out[n].collect()}
    assert said("p") == {
        1: [], 2: ["duplicate (id)"], 3: ["duplicate (name)"], 4: ["name is required"], 5: ["id is required"], 6: ["name longer than 3"], 7: [],
    }
    assert said("c") == {
        1: [], 2: ["unknown pid in p"], 3: ["x above 5"], 4: ["duplicate (a, b)"], 5: ["duplicate (id)"], 6: ["x below 0"],
    }
    empty = C.check_tables({"c": c.limit(0), "p": p.limit(0)}, rules, {"c": ["seq"], "p": ["seq"]})
    assert C.reason_counts(empty).count() == 0
    with pytest.raises(ValueError):
        C.parents_first({"a": C.TableRules(("i",), references=(C.Reference("x", "b", "i"),)), "b": C.TableRules(("i",), references=(C.Reference("x", "a", "i"),))})


def test_document_checks(spark):
    what = DOC.Fields(
        ("id", "tags"),
        {
            "id": DOC.Value(("int",)), "kind": DOC.Value(("string", "null"), allowed=("a", "b")), "n": DOC.Value(("int", "double"), low=0, high=5),
            "tags": DOC.Items(DOC.Value(("string",))), "at": DOC.Value(("date",)), "in": DOC.Fields(("x",), {"y": DOC.Items(DOC.Items(DOC.Value(("bool",))))}),
        },
    )
    cases = [
        ('{"id": 1, "tags": []}', []),
        ('{"id": 2147483648, "tags": ["x", 1, null]}', ["id must be int", "tags[] must be string"]),
        ('{"id": null}', ["tags is required", "id must be int"]),
        ('{"id": 1, "tags": "x", "kind": "c"}', ["kind not allowed", "tags must be array"]),
        ('{"id": 1, "tags": [], "kind": null, "n": 5.5}', ["n above 5"]),
        ('{"id": 1, "tags": [], "n": -1, "at": {"$date": "2024-02-30T00:00:00Z"}}', ["n below 0", "at must be date"]),
        ('{"id": 1, "tags": [], "n": "1", "at": {"$date": "2024-02-03T00:00:00Z"}}', ["n must be int or double"]),
        ('{"id": 1, "tags": [], "in": {"y": [[true], [false, 0]]}}', ["in.x is required", "in.y[][] must be bool"]),
        ('{"id": 1, "tags": [], "in": []}', ["in must be object"]),
        ("[]", ["document must be object"]), ("no json", ["document must be object"]), (None, ["document must be object"]),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, body string")
    checked = DOC.check_documents(docs.select("i", VT.parsed("body").alias("document")), what)
    got = {r["i"]: r["reasons"] for r in checked.select("i", "reasons").collect()}
    assert got == {i: c[1] for i, c in enumerate(cases)}
    assert DOC.check_documents(spark.createDataFrame([('{"name": "x"}',)], "b string").select(VT.parsed("b").alias("document")), DOC.required_fields("id", "name")).first()["reasons"] == ["id is required"]


def test_mixed_lists(spark):
    bodies = ['{"v": [{"id": 1, "name": "a"}]}', """{"v": "[{'id': 2, 'name': None}]"}""", '{"v": "[{\\"id\\": 3, \\"name\\": \\"c\\"}]"}', '{"v": "junk"}', '{"v": 5}', "{}", '{"v": null}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, b string").select("i", VT.parsed("b").alias("d"))
    got = rows.select("i", VT.as_list(VT.at(F.col("d"), "v"), NAMED_ITEM).alias("v")).orderBy("i").collect()
    assert [[tuple(x) for x in r["v"]] for r in got] == [[(1, "a")], [(2, None)], [(3, "c")], [], [], [], []]
    numbers = spark.createDataFrame([(x,) for x in ('{"a": {"b": 1}}', '{"a": {"b": "1"}}', '{"a": {"b": 1.5}}', '{"a": 1}', "{}")], "b string")
    b = VT.at(VT.parsed("b"), "a", "b")
    assert [r[0] for r in numbers.select(F.coalesce(VT.is_number(b), F.lit(False))).collect()] == [True, False, True, False, False]


def test_type_names_are_read_once_a_value(spark):
    # before: each rule read the type name of the document and of all that lies on its way
    docs = spark.createDataFrame([('{"a": {"b": [{"c": 1}, {"c": "x"}]}, "n": 1.5}',), ("[1]",), (None,)], "body string")
    item = DOC.Fields(("c", "d"), {"c": DOC.Value(("int",), low=0, high=5), "d": DOC.Value(("date",))})
    what = DOC.Fields(("a", "z"), {"a": DOC.Fields(("b",), {"b": DOC.Items(item)}), "n": DOC.Value(("int", "null"), low=0, high=5)})
    checked = DOC.check_documents(docs.select(VT.parsed("body").alias("document")), what)
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    try:
        plan = checked._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    assert 0 < plan.count("schemaOfVariant") <= 20  # before: 106
    assert [r["reasons"] for r in checked.collect()] == [
        ["z is required", "a.b[].d is required", "a.b[].c must be int", "n must be int or null"], ["document must be object"], ["document must be object"],
    ]


def test_ranges_are_bounded_by_bytes(spark, tmp_path):
    # before: ranges followed rows only, so a task sorted as many bytes as two million rows have
    rows = spark.range(400).select(F.col("id").alias("k"), F.array_repeat(F.struct(F.repeat(F.lit("x"), 1000).alias("s")), 10).alias("x"))
    table = KeyRangeTable(spark, str(tmp_path / "t"), ["k"], target_bytes=1 << 20).create(rows)
    made = table._manifest()
    assert len(made) >= 4 and max(e["size"] for e in made) <= 2 << 20
    assert sum(e["size"] for e in made) >= 400 * 10 * 1000
    table.delete(spark.range(0, 400, 2).select(F.col("id").alias("k")))
    assert sorted(r["k"] for r in table.read().collect()) == list(range(1, 400, 2))
    assert max(e["size"] for e in table._manifest()) <= 2 << 20
    whole = table.read()
    table.upsert(whole.select("k", F.array_repeat(F.col("x")[0], 60).alias("x"), F.lit(1).alias("seq")), "seq")
    assert max(e["size"] for e in table._manifest()) <= 2 << 20 and table.read().filter(F.size("x") == 60).count() == 200
