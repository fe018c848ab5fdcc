"""Which operators run Python code, staged steps included, and what no plan may hold."""

from __future__ import annotations

import pytest

from strata.llm import bisector, decontam, jaccard, langid, mixing, pii, quality, queries, radix_dedup, sharding, suffix_dedup, term_audit, toxicity, warc
from tests.test_plans import PYTHON, nodes, physical

SF_DIR = "/root/testdata/sf0.001"

#: Queries on whose way no Python worker takes part.
NATIVE = {"op3_radix_dedup", "op5_hash_tree_shards", "op10_water_filling_mix"}
MODULES = (bisector, decontam, jaccard, langid, mixing, pii, quality, radix_dedup, sharding, suffix_dedup, term_audit, toxicity, warc)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plans_of_all_steps(spark, monkeypatch, name):
    plans, frames = [], []

    def watched(stage):
        def step(df, label):
            frames.append(df)
            return stage(df, label)

        return step

    for module in MODULES:
        if hasattr(module, "stage"):
            monkeypatch.setattr(module, "stage", watched(module.stage))
    frames.append(queries.QUERIES[name](spark, SF_DIR))
    plans = [physical(df) for df in frames]
    assert not [p for p in plans if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    python = {word for p in plans for word in PYTHON if word in p}
    assert not python if name in NATIVE else True
    if name != "op10_water_filling_mix":  # the sources of a mix are ranked as a whole
        for df in frames:
            for node in nodes(df._jdf.queryExecution().optimizedPlan()):
                assert node.nodeName() != "Window" or not node.partitionSpec().isEmpty(), node.simpleString(200)
