from __future__ import annotations

import contextlib
import io
import re


def rows(df, *columns):
    """Sorted tuples of a result."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(df) -> str:
    """The physical plan as it stands before it runs."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def exchanges(df) -> list[str]:
    """The kinds of the plan's shuffles."""
    return re.findall(r"\) Exchange\nInput.*\nArguments: (\w+)", plan_of(df))
