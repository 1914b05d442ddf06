"""Evaluate costly expressions once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MADE = "_made"


def computed_once(df: DataFrame, costly: dict[str, Column], cheap: dict[str, Column]) -> DataFrame:
    """Select ``cheap`` and ``costly`` columns; filters on costly ones do not repeat their work.

    Catalyst moves a filter below a projection by copying the projected expressions into the
    filter, so a parsed date would be parsed once per mention and once more for the output.
    A generator over one struct keeps its expressions in one place, inside the same codegen
    stage. All expressions refer to the columns of ``df``; cheap ones may use ``made`` too.
    """
    struct = F.struct(*[expression.alias(name) for name, expression in costly.items()])
    return df.select("*", F.explode(F.array(struct)).alias(MADE)).select(
        *[expression.alias(name) for name, expression in cheap.items()],
        *[made(name).alias(name) for name in costly],
    )


def made(name: str) -> Column:
    """A costly column inside a cheap expression."""
    return F.col(f"{MADE}.{name}")
