from __future__ import annotations

import pytest
from helpers import rows

from propgraph import Nodes, PropertyGraph, constraint_report, key_violations, unique_violations


@pytest.fixture
def twice(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, v string")


def test_unique_ignores_nulls_and_key_reports_them(twice):
    assert rows(unique_violations(twice, "id")) == [(1, 2)]
    assert rows(key_violations(twice, "id")) == [(1, 2), (None, 2)]
    assert rows(key_violations(twice.where("v = 'd'"), "id")) == [(None, 1)]


def test_report(twice):
    graph = PropertyGraph({"N": Nodes(twice, ("id",))})
    out = constraint_report(graph, [("N", "id", "key"), ("N", "v", "unique"), ("N", "id", "unique")])
    assert out.columns == ["label", "property", "kind", "violations"]
    assert rows(out) == [("N", "id", "key", 3), ("N", "id", "unique", 1), ("N", "v", "unique", 0)]
    with pytest.raises(ValueError):
        constraint_report(graph, [("N", "id", "exists")])


def test_report_on_an_empty_label(twice):
    graph = PropertyGraph({"N": Nodes(twice.where("false"), ("id",))})
    assert rows(constraint_report(graph, [("N", "id", "key")])) == [("N", "id", "key", 0)]


def test_report_without_constraints(twice):
    with pytest.raises(ValueError, match="no constraint"):
        constraint_report(PropertyGraph({"N": Nodes(twice, ("id",))}), [])
