"""Versions: one commit for all relations, replaced by key, readable at every number, whole after a broken run."""

import pytest

from ledgerloom.sources import staged
from ledgerloom.sources.versions import Conflict, Versions, with_styles

ROWS = "source_key string, name string, category string, status string"


def _rows(spark, *rows):
    return spark.createDataFrame([(s, n, "c", "Active") for s, n in rows], ROWS)


def _read(v, name="combine_list", **kw):
    return sorted((r.source_key, r.name) for r in v.read(name, **kw).collect())


def test_commit_replaces_by_key(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "out"))
    assert v.latest() is None and v.numbers() == []
    key = {"combine_list": "source_key"}
    assert v.commit({"combine_list": _rows(spark, ("a", "1"), ("b", "2"), ("x/y z", "3")), "log": _rows(spark, ("l", "0"))}, key) == 0
    assert v.commit({"combine_list": _rows(spark, ("a", "9"), ("d", "4"))}, key) == 1
    assert _read(v) == [("a", "9"), ("b", "2"), ("d", "4"), ("x/y z", "3")]
    assert _read(v, number=0) == [("a", "1"), ("b", "2"), ("x/y z", "3")]
    assert _read(v, "log") == [("l", "0")]
    assert _read(v, values=["a", "b"]) == [("a", "9"), ("b", "2")]
    assert {r.value: r.run for r in v.origin("combine_list").collect()}["b"] == v.manifest(0)["run"]
    assert v.commit({"combine_list": _rows(spark, ("a", "5")), "log": _rows(spark)}, key, {"combine_list": ["b"]}) == 2
    assert _read(v) == [("a", "5"), ("d", "4"), ("x/y z", "3")] and _read(v, "log") == []
    assert sorted(r.name for r in staged.previous_snapshot(spark, v.folder).collect()) == ["3", "4", "5"]


def test_broken_run_is_unseen(spark, tmp_path, monkeypatch):
    v = Versions(spark, str(tmp_path / "out"))
    v.commit({"combine_list": _rows(spark, ("a", "1")), "log": _rows(spark, ("l", "1"))})
    real = Versions.write

    def dies(self, name, *args):
        if name == "log":
            raise RuntimeError("killed")
        return real(self, name, *args)

    monkeypatch.setattr(Versions, "write", dies)
    with pytest.raises(RuntimeError):
        v.commit({"combine_list": _rows(spark, ("a", "2")), "log": _rows(spark, ("l", "2"))})
    monkeypatch.undo()
    assert v.latest() == 0 and _read(v) == [("a", "1")] and _read(v, "log") == [("l", "1")]
    v.commit({"combine_list": _rows(spark, ("a", "3")), "log": _rows(spark, ("l", "3"))})
    assert _read(v) == [("a", "3")] and v.vacuum(1) == 3 and _read(v) == [("a", "3")] and v.numbers() == [1]


def test_two_at_once(spark, tmp_path, monkeypatch):
    """Who comes second goes on top of the first; a taken number is never overwritten."""
    one, two = (Versions(spark, str(tmp_path / "out")) for _ in range(2))
    one.commit({"combine_list": _rows(spark, ("a", "1"))}, {"combine_list": "source_key"})
    real, met = Versions._publish, []

    def late(self, manifest):
        if self is two and not met:
            met.append(1)
            one.commit({"combine_list": _rows(spark, ("b", "2"))}, {"combine_list": "source_key"})
        real(self, manifest)

    monkeypatch.setattr(Versions, "_publish", late)
    assert two.commit({"combine_list": _rows(spark, ("c", "3"))}, {"combine_list": "source_key"}) == 2
    assert _read(two) == [("a", "1"), ("b", "2"), ("c", "3")]
    with pytest.raises(Conflict):
        real(one, {"number": 1, "run": "r", "relations": {}})
    assert _read(one, number=1) == [("a", "1"), ("b", "2")]


def test_styles(spark):
    c = spark.createDataFrame([("Yes", 1), ("Yes", 2), ("No", 2), (None, 3)], "is_final string, category_count int")
    s = spark.createDataFrame([(1, 1), (1, 2), (1, None)], "extracted int, expected_count int")
    got = with_styles({"combine_list": c, "release_summary": s, "other": s})
    assert [(r.muted, r.highlighted) for r in got["combine_list"].collect()] == [(False, False), (False, True), (True, False), (False, False)]
    assert [r.highlighted for r in got["release_summary"].collect()] == [False, True, False] and got["other"].columns == s.columns
