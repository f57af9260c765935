from __future__ import annotations

import pandas as pd


def rows(df: pd.DataFrame) -> list[tuple]:
    """Sorted rows as texts, columns by name."""
    names = sorted(df.columns)
    one = lambda v: "NULL" if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(one, r)) for r in df[names].astype(object).itertuples(index=False))


def same(found: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)
