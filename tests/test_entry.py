"""The entry works with and without the llm subpackage, and without a library that only it needs."""

import importlib
import sys

import pytest


@pytest.mark.parametrize("hidden", ["xxhash", "alertloom.llm", "corpus_pipeline"])
def test_queries_without(monkeypatch, hidden):
    for name in [m for m in sys.modules if m == hidden or m.startswith(("alertloom.llm", "corpus_pipeline", f"{hidden}."))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, hidden, None)
    entry = importlib.import_module("__spark_entry__")
    known = entry.queries()
    assert "balanced_alerts" in known and "pipeline" not in known
    assert {k for k in known if not k.startswith("op")} >= {"name_clean", "audit_pairs"}
    assert set(entry.oracle_sql()) <= set(known)
    if hidden != "corpus_pipeline":
        assert not any(k.startswith("op1_") for k in known)
