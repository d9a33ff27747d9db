"""Rows of a small result as sorted tuples, for comparing tables."""


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
