"""Plain helpers of the tests."""


def rows(df, *columns):
    """Collected rows as a sorted list of tuples (None sorts first)."""
    out = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
