"""Result sets as plain Python values."""

from collections import Counter


def plain(value):
    return tuple(value) if isinstance(value, list) else value


def rows(df, *columns):
    """The rows as a multiset of tuples."""
    chosen = df.select(*columns) if columns else df
    return Counter(tuple(plain(v) for v in row) for row in chosen.collect())


def plan_text(df):
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
