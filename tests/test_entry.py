import importlib.util
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry()
    rows = mod.entry(spark).collect()
    assert {r["risk_class"] for r in rows} <= {"Low", "Medium", "High"}
    assert sum(r["n"] for r in rows) > 0


def test_contract_keys():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def test_missing_dependency_leaves_the_other_queries(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tabrisk.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    with pytest.warns(UserWarning, match="left out"):
        mod = _entry()
    assert "class_distribution" in mod.queries() and not [k for k in mod.queries() if k.startswith("op") and k[2].isdigit()]
