"""Rows of frames for comparison in tests."""


def rows(df, *cols):
    """Sorted list of tuples of the selected columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
