"""Column names as they arrive, and as the library uses them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake(name: str) -> str:
    """`GICS Sub-Industry` -> `gics_sub_industry`."""
    return re.sub(r"[\s\-]+", "_", name.strip().lower())


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case every column, with `_` for spaces and hyphens."""
    renamed = [snake(name) for name in df.columns]
    clashes = sorted({name for name in renamed if renamed.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalising: {clashes}")
    return df.toDF(*renamed)

