"""COVERAGE.md says what the code does: cited functions exist, and what is cited as a check reaches them."""

import re

from folioscale import catalogue

from . import coverage_graph


def test_coverage_is_evidence():
    graph = coverage_graph.library()
    queries, tests = coverage_graph.by_queries(graph), coverage_graph.by_tests(graph)
    assert set(queries) == set(catalogue.queries())
    found = coverage_graph.rows()
    assert len(found) > 400
    for number, functions, checks in found:
        assert functions and all(f in graph.bodies for f in functions), (number, [f for f in functions if f not in graph.bodies])
        if checks == coverage_graph.NOTHING:
            continue
        checks, _, unreached = checks.partition("; nothing reaches ")
        reached = set(re.findall(r"`([^`]+)`", unreached))
        for test, name in re.findall(r"(test )?`([^`]+)`", checks):
            reached |= (tests if test else queries)[name]
        assert set(functions) <= reached, (number, set(functions) - reached)
