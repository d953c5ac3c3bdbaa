"""Property tests: the literal-list parser reads back whatever Python's repr writes."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cinemetric.functions import cleaning as C

names = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12))
items = st.fixed_dictionaries({"id": st.one_of(st.none(), st.integers(-10**12, 10**12)), "name": names})
lists = st.lists(st.lists(items, max_size=4), min_size=1, max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=lists)
def test_literal_list_round_trip(spark, batch):
    rows = [(i, repr(v)) for i, v in enumerate(batch)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", C.literal_list("v").alias("p"))
    got = {r.i: [{"id": e["id"], "name": e["name"]} for e in r.p] for r in df.collect()}
    assert got == dict(enumerate(batch))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=lists)
def test_jsonish_reads_json_and_literals_alike(spark, batch):
    import json

    rows = [(i, json.dumps(v) if i % 2 else repr(v)) for i, v in enumerate(batch)]
    p, raw = C.jsonish("v")
    df = spark.createDataFrame(rows, "i int, v string").select("i", p.alias("p"), raw.alias("raw"))
    out = df.collect()
    assert all(r.raw is None for r in out)
    assert {r.i: [{"id": e["id"], "name": e["name"]} for e in r.p] for r in out} == dict(enumerate(batch))
