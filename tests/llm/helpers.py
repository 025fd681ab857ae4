import pandas as pd


def rows_of(df, cols):
    """Rows as comparable tuples, nulls as None, whole floats as integers."""
    def plain(x):
        if isinstance(x, (list, dict)):
            return str(x)
        if pd.isna(x):
            return None
        x = x.item() if hasattr(x, "item") else x
        return int(x) if isinstance(x, float) and x == int(x) else x
    return sorted((tuple(map(plain, r)) for r in df[cols].itertuples(index=False)), key=str)
