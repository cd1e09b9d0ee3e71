"""Print the formatted physical plans of the main operators (scan pruning, shuffles,
aggregation strategy). usage: python tools/explain_plans.py [sf_dir]"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kgspark.operators import documents as D  # noqa: E402
from kgspark.operators import extract as X  # noqa: E402
from kgspark.operators import graph as G  # noqa: E402
from kgspark.plans.build import cached_extraction  # noqa: E402
from kgspark.session import build_session  # noqa: E402
from kgspark.sources.driver import read_source  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]")
    ex = cached_extraction(spark, sf)
    plans = {
        "A1 document dedup": D.dedup_documents(read_source(spark, "documents", sf)),
        "A2 entity merge": X.merge_entities(ex.entity_mentions),
        "A3/A4 relationship merge": X.merge_relationships(ex.relationship_mentions),
        "J1/J2 endpoint resolution": G.resolve_endpoints(ex.relationships_raw,
                                                         G.collapse_titles(ex.entities_raw)),
    }
    for name, df in plans.items():
        print("=" * 20, name)
        df.explain("formatted")


if __name__ == "__main__":
    main()
