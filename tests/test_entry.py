"""The entry works with or without the corpus subpackage."""

import sys

import __spark_entry__ as entry


def test_market_keys_without_the_corpus_subpackage(monkeypatch):
    with_corpus = set(entry.queries())
    monkeypatch.setitem(sys.modules, "barloom.llm.queries", None)       # its import fails
    keys = set(entry.queries())
    assert keys and keys <= with_corpus and not any(k.startswith("op") and k[2].isdigit() for k in keys)
    assert set(entry.oracle_sql()) <= keys
