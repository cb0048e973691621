"""Which element a node is, and which elements enclose it.

A node row carries ``path``: its enclosing elements from the outermost to the innermost,
each as ``(pre, sel)`` with ``sel`` like ``"div #contactsGrid .k-grid .wide "``. Asking
"inside of which row/cell/panel" is therefore an expression on the node row itself;
no node is ever joined to another node.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A test on an enclosing element: the SQL name of its ``sel`` -> an SQL condition.
Test = Callable[[str], str]


def is_a(tag: str | None = None, *classes: str, id: str | None = None) -> Column:
    """Test on a node row: tag, every class token, id."""
    tests = [f"tag = '{tag}'"] if tag else []
    tests += [f"array_contains(cls, '{c}')" for c in classes]
    if id is not None:
        tests.append(f"id = '{id}'")
    return F.expr(f"coalesce({' AND '.join(tests)}, false)")


def sel_is(tag: str | None = None, *classes: str, id: str | None = None) -> Test:
    """The same test on the ``sel`` of an enclosing element."""

    def test(sel: str) -> str:
        tests = [f"startswith({sel}, '{tag} ')"] if tag else []
        tests += [f"contains({sel}, ' .{c} ')" for c in classes]
        if id is not None:
            tests.append(f"contains({sel}, ' #{id} ')")
        return f"({' AND '.join(tests)})"

    return test


def enclosing(test: Test) -> Column:
    """``pre`` of every enclosing element that passes, outermost first."""
    return F.expr(f"transform(filter(path, p -> {test('p.sel')}), p -> p.pre)")
