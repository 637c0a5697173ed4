"""Helpers that several tests use."""

import contextlib
import io


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted(tuple(r) for r in df.select(*(order or df.columns)).collect())


def plan_of(df):
    """The formatted physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
