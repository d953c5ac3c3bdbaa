"""Write PLANS.md: condensed physical plans of representative registered queries.

Usage: ``python tests/plan_snapshot.py [sf_dir] [stored_folder]``.  Plans are taken before
execution (AQE may still switch joins to broadcast at run time).  Each line keeps the operator
and its keys; attribute ids and file locations are dropped.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

RAW = ["title_search", "combined_search_rating", "movie_full_details", "event_funnel", "facet_counts",
       "conversion_funnel", "trending", "person_cast_roles", "sibling_genres", "ingest_ratings_upsert",
       "validate_rating_rows", "doc_ratings_list_low"]
STORED = ["probe_combined", "probe_genre", "title_search", "movie_full_details", "genre_movies_all"]


def condense(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not line.strip() or line.startswith("=="):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: [^,]*, ", "", line)
        line = re.sub(r"Batched: true, |Format: Parquet, ", "", line)
        out.append(line[:180].rstrip())
    return "\n".join(out)


def main(argv):
    from cinemetric.session import build_session
    from cinemetric.sources.catalogue import Catalogue, StoredCatalogue

    from cinemetric import registry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    stored_dir = argv[2] if len(argv) > 2 else None
    spark = build_session("local[8]", 16)
    reg = registry.all_queries()
    parts = ["# PLANS", "", f"Physical plans before execution (`{os.path.basename(sf_dir)}`, local[8], 16 shuffle",
             "partitions), condensed by `tests/plan_snapshot.py`.", ""]
    cat = Catalogue(spark, sf_dir)
    for name in RAW:
        plan = reg[name](cat)._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name} (raw catalogue)", "", "```", condense(plan), "```", ""]
    if stored_dir:
        scat = StoredCatalogue(spark, stored_dir, sf_dir)
        for name in STORED:
            plan = reg[name](scat)._jdf.queryExecution().executedPlan().toString()
            parts += [f"## {name} (materialised catalogue)", "", "```", condense(plan), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
