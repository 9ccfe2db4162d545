"""Regex helpers with Python-compatible semantics on the JVM.

Patterns in the configuration are written for Python's ``re``.  Java regex
differs in three ways that matter here: ``\\w``/``\\b``/``\\s`` are ASCII
unless UNICODE_CHARACTER_CLASS (``(?U)``) is on, ``.`` also stops at
``\\r``/``\\u0085``/``\\u2028``/``\\u2029`` unless UNIX_LINES (``(?d)``), and
case folding needs ``(?i)``.  ``rlike`` has search (find) semantics, like
``re.search``.
"""

from __future__ import annotations

from pyspark.sql import Column

PY_FLAGS = "(?dU)"
PY_FLAGS_I = "(?diU)"


def py_pattern(pattern: str, ignore_case: bool = True) -> str:
    return (PY_FLAGS_I if ignore_case else PY_FLAGS) + pattern


def search(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """``bool(re.search(pattern, text, re.I))`` as a JVM expression."""
    return text.rlike(py_pattern(pattern, ignore_case))
