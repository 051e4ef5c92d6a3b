"""Paths and comparisons shared by the test modules."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, order=None):
    """Rows as sorted tuples of python values (order-insensitive compare)."""
    cols = sorted(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
