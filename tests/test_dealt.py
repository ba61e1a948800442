"""Rows dealt by scene once are not dealt again by the ring operators."""

import pytest

from __spark_entry__ import queries
from conftest import SF
from pairgrid.operators import audit


@pytest.mark.parametrize("name", ["w5_pick_source", "a6_pair_conflicts", "j8_visible_by_camera", "g3_candidate_groups", "f13_ring_sources", "p26_selected_groups"])
def test_records_move_once(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.split("\n") if "hashpartitioning(scene_name" in line]
    assert moves and not [line for line in moves if "REPARTITION_BY_COL" not in line]


def test_repeats_are_found_in_one_move_without_hashes(spark):
    plan = queries()["w2_exclusions"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "REPARTITION_BY_COL" not in line]
    assert len(moves) == 1 and "_content" in moves[0] and "Join" not in plan


def test_the_roles_of_a_name_move_as_one_row(spark):
    h = "a" * 64
    rows = spark.createDataFrame(
        [("s", "gt", "s.png", h), ("s", "input", "s.png", h), ("s", "target", "s.png", "short"), ("u", "gt", None, h), ("v", "gt", "v.png", h)],
        "sample_id STRING, role STRING, name STRING, expected STRING",
    )
    files = spark.createDataFrame([("gt", "s.png", h), ("gt", "s.png", "A" * 64), ("input", "s.png", None), ("gt", "v.png", h)], "role STRING, name STRING, sha256 STRING")
    errors = audit.content_errors(rows, files)
    assert sorted(tuple(r) for r in errors.collect()) == [
        ("s", "gt", "hash_mismatch"), ("s", "input", "missing_file"), ("s", "target", "invalid_content_hash"), ("u", "gt", "missing_file"),
    ]
    assert audit.looked_up(rows, files).columns == ["sample_id", "role", "sound", "found", "same"]
