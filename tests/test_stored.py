"""Queries over the materialised catalogue equal the same queries over the raw tables."""

import os

import pytest

from cinemetric import registry

REGISTRY = registry.all_queries()


@pytest.fixture(scope="module")
def stored(spark, cat):
    from cinemetric.session import checkpoint_dir
    from cinemetric.sources.catalogue import materialize

    return materialize(cat, os.path.join(checkpoint_dir(spark), f"test-catalogue-{os.getpid()}"))


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - registry.WRITES))
def test_stored_equals_raw(cat, stored, name):
    raw = REGISTRY[name](cat)
    got = REGISTRY[name](stored)
    assert got.columns == raw.columns
    assert got.exceptAll(raw).count() == 0 and raw.exceptAll(got).count() == 0
