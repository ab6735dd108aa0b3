"""The registry with and without its removable part."""

import importlib.util
import sys
from pathlib import Path

import pytest

from coldkeep.checks.oracle import ORACLE
from coldkeep.checks.queries import QUERIES

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


def loaded():
    spec = importlib.util.spec_from_file_location("entry_again", ENTRY)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("missing", ["corpus_pipeline", "coldkeep.llm", "coldkeep.llm.queries", "public_tokenizers"])
def test_core_queries_do_without_the_removable_part(monkeypatch, missing):
    """A folder that is gone, left over empty, or lacks a package leaves all other queries."""
    for name in [m for m in sys.modules if m.startswith(("coldkeep.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    entry = loaded()
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)


def test_nothing_else_imports_the_removable_part():
    root = ENTRY.parent / "coldkeep"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "coldkeep.llm" not in path.read_text(), path
