def values(df):
    """The rows of a table as plain tuples."""
    return [tuple(r) for r in df.collect()]
