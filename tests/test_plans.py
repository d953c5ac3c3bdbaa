"""Physical-plan properties that must hold for every registered query."""

import re

import pytest

from cinemetric import registry

REGISTRY = registry.all_queries()
# only the file-parsing jobs may call Python (the literal-list fallback of C-01/C-02)
PYTHON_ALLOWED = {"ingest_movies_parsed", "ingest_genre_dimension", "ingest_movie_genres", "ingest_company_dimension",
                  "ingest_movie_documents", "ingest_credit_documents", "ingest_keywords", "ingest_movie_companies",
                  "ingest_keyword_dimension", "ingest_movie_keywords", "mixed_cast_lists", "mixed_lists_converted",
                  "movie_embedded_objects"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - registry.WRITES))
def test_plan_has_no_pairwise_or_python_steps(cat, name):
    plan = REGISTRY[name](cat)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    if name not in PYTHON_ALLOWED:
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|PythonUDF", plan)
    # every window is partitioned except ordered_index's offset table (one row per partition)
    for w in re.findall(r"Window \[[^\n]*", plan):
        assert "_part" in w or re.search(r"\], \[[^\]]+\], \[", w), w


def test_event_window_reaches_the_scan(cat):
    plan = REGISTRY["event_funnel"](cat)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThanOrEqual\(ts,", plan)


def test_facets_single_scan(cat):
    plan = REGISTRY["facet_counts"](cat)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
