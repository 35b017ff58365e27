def rows_of(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
