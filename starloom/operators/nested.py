"""Rewriting of text inside nested records."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import holds_text, replace_text


def replace_text_deep(
    df: DataFrame, keyword: str, replacement: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace ``keyword`` in every string of ``columns``, at any depth.

    All columns by default. Promotes configuration records from one
    environment's names to another's; map keys and field names are kept, also
    those of variants.
    """
    chosen = df.columns if columns is None else columns
    rewritten = {
        name: replace_text(F.col(name), df.schema[name].dataType, keyword, replacement)
        for name in chosen
        if holds_text(df.schema[name].dataType)
    }
    return df.withColumns(rewritten) if rewritten else df
