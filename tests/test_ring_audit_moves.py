"""What the ring audit moves: ids, digests and asset lists, but no views."""

from __future__ import annotations

from conftest import SF

from pairgrid.operators import audit
from pairgrid.plans import audit_queries


def joined_columns(df):
    """Names of the columns on the sides of all joins."""
    found, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        parts = [node.children().apply(i) for i in range(node.children().size())]
        todo += parts
        if node.nodeName() == "Join":
            for part in parts:
                out = part.output()
                found |= {out.apply(i).name() for i in range(out.size())}
    return found


def test_views_are_not_joined(spark):
    groups, sources, seen, canonical = audit_queries._damaged(spark, SF)
    moved = joined_columns(audit.group_errors(groups, sources.limit(10), seen, canonical))
    assert "claimed" in moved and not moved & {"v", "views", "baseline", "pair", "record_sha256"}


def test_hashes_of_the_same_bytes_in_other_letters_differ(spark):
    view = "array(named_struct('camera_id', '0', 'files', named_struct('gt', 'g', 'input', 'i', 'target', 't'), 'content_sha256', named_struct('gt', '{0}', 'input', '{0}', 'target', '{1}')))"
    groups = spark.sql("select 's__f001__g' as group_id, " + view.format("ab" * 32, "x" * 64) + " as views")
    files = spark.createDataFrame([("g", "AB" * 32), ("i", "ab" * 32), ("t", None), ("t", "x" * 64), ("u", "ab" * 32)], "name string, sha256 string")
    none = spark.createDataFrame([], "group_id string, errors array<string>")
    own, audit.group_errors = audit.group_errors, lambda *a: none
    try:
        found = sorted((r.subject, tuple(r.errors)) for r in audit.audit_rings(groups, None, None, None, files).collect())
    finally:
        audit.group_errors = own
    assert found == [("__release__", ("flat_png_membership_mismatch",)), ("g", ("hash_mismatch",)), ("t", ("not_regular_file",))]
