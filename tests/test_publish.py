"""Four lists become visible at once, or not at all."""

from __future__ import annotations

import pytest

from conftest import SF001
from ebbtide import run
from ebbtide.config import FIXTURE_AS_OF, SegmentConfig
from ebbtide.plans import lists
from ebbtide.sources import fixtures, sinks
from ebbtide.sources.versions import Versions
from test_run import _argv, _rows, _write_inputs

NEXT_DAY = "2020-08-15 12:00:00"


def _published(spark, out, date=None):
    return {n: _rows(sinks.published(spark, out, n, date)) for n in lists.LISTS}


def test_a_run_killed_between_lists_changes_nothing(spark, tmp_path, monkeypatch):
    p = _write_inputs(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    run.run(spark, run.parse(_argv(p, out, "--publish")))
    t = fixtures.tables(spark, SF001)
    first = _published(spark, out)
    assert first == {n: _rows(df) for n, df in lists.all_lists(t, SegmentConfig(as_of=FIXTURE_AS_OF)).items()}

    made = []
    real = lists.details_from
    monkeypatch.setattr(lists, "details_from", lambda d, c: made.append(1) or real(d, c).selectExpr("raise_error('killed') as run_date"))
    for as_of in (FIXTURE_AS_OF, NEXT_DAY):  # a repeated date and a new one
        with pytest.raises(Exception, match="killed"):
            run.run(spark, run.parse(_argv(p, out, "--publish", "--as-of", as_of)))
        assert _published(spark, out) == first
    monkeypatch.undo()
    assert len(made) == 2 and len(Versions(spark, out).numbers()) == 1

    run.run(spark, run.parse(_argv(p, out, "--publish", "--as-of", NEXT_DAY)))
    assert _published(spark, out, "2020-08-14") == first
    second = _published(spark, out, "2020-08-15")
    assert second == {n: _rows(df) for n, df in lists.all_lists(t, SegmentConfig(as_of=NEXT_DAY)).items()}
    both = _published(spark, out)
    assert {n: len(r) for n, r in both.items()} == {n: len(first[n]) + len(second[n]) for n in first}
    # a repeated date replaces its lists, those that the run makes
    run.run(spark, run.parse(_argv(p, out, "--publish", "--lists", "base", "--as-of", NEXT_DAY)))
    assert _published(spark, out) == both
    Versions(spark, out).prune(1)
    assert _published(spark, out) == both


def test_two_runs_at_a_time_both_publish(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    a, b = spark.range(3), spark.range(5)
    real = Versions.commit
    meanwhile = []

    def slow(self, number, manifest):
        if not meanwhile:  # another run commits just before
            meanwhile.append(1)
            sinks.publish({"base": b}, out, "2020-08-15")
        real(self, number, manifest)

    monkeypatch.setattr(Versions, "commit", slow)
    sinks.publish({"base": a}, out, "2020-08-14")
    monkeypatch.undo()
    assert sinks.published(spark, out, "base", "2020-08-14").count() == 3
    assert sinks.published(spark, out, "base", "2020-08-15").count() == 5
    with pytest.raises(LookupError, match="no list 'metro'"):
        sinks.published(spark, out, "metro")
    with pytest.raises(LookupError, match="for 2019"):
        sinks.published(spark, out, "base", "2019-01-01")


def test_an_empty_list_is_published(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.publish({"base": spark.range(0)}, out, "2020-08-14")
    assert sinks.published(spark, out, "base").columns == ["id"] and sinks.published(spark, out, "base").count() == 0


def test_the_job_keeps_a_state(spark, tmp_path):
    """Two runs with --state: the second reads the orders that arrived since; lists equal those of full runs."""
    p = _write_inputs(spark, tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    more = ("--publish", "--state", state, "--arrived-until")
    run.run(spark, run.parse(_argv(p, out, *more, "2024-01-20 00:00:00")))
    half = _published(spark, out)
    run.run(spark, run.parse(_argv(p, out, *more, "2024-02-01 00:00:00")))
    t = fixtures.tables(spark, SF001)
    assert _published(spark, out) == {n: _rows(df) for n, df in lists.all_lists(t, SegmentConfig(as_of=FIXTURE_AS_OF)).items()}
    early = t.orders.filter("delivered_at < timestamp_ntz'2024-01-20 00:00:00'")
    import dataclasses

    cut = dataclasses.replace(t, orders=early)
    assert half == {n: _rows(df) for n, df in lists.all_lists(cut, SegmentConfig(as_of=FIXTURE_AS_OF)).items()}
    with pytest.raises(ValueError, match="folders"):
        run.run(spark, run.parse(_argv(p, out, "--publish", "--out-catalog")))
