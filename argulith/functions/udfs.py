"""User functions over texts, in Arrow batches; rows keep their key instead of their position."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_texts(
    df: DataFrame, fn: Callable[[str], Any], text_col: str = "text", out: str = "result", returns: str = "string"
) -> DataFrame:
    """Apply ``fn`` to every text."""

    @F.pandas_udf(returns)
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(fn, na_action="ignore")

    return df.withColumn(out, mapped(F.col(text_col)))


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], Callable[[str], Any]],
    text_col: str = "text",
    out: str = "result",
    returns: str = "string",
) -> DataFrame:
    """Like ``map_texts``, with a function that ``setup`` makes once per task, e.g. a loaded model."""

    @F.pandas_udf(returns)
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = setup()
        for texts in batches:
            yield texts.map(fn, na_action="ignore")

    return df.withColumn(out, mapped(F.col(text_col)))
