"""Columns as rows: many columns go through one small aggregate instead of one aggregate each.

An array of the cells is exploded with its positions. Its generated code does
not grow with the number of aggregates, and only the position travels as key;
hundreds of columns would otherwise make one method too large to compile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITION = "position"


def quoted(name: str) -> str:
    """A column name for use inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def long_cells(df: DataFrame, cells: Sequence[Column] | Sequence[str], value: str = "value") -> DataFrame:
    """position, value: one row per row and cell. All cells have the same type.

    Cells may be SQL text, which is parsed in one go: building hundreds of
    columns call by call takes longer than many a query.
    """
    if all(isinstance(cell, str) for cell in cells):
        array = F.expr(f"array({', '.join(cells)})")
    else:
        array = F.array(*cells)
    return df.select(F.posexplode(array).alias(POSITION, value))


def names_table(df: DataFrame, names: Sequence[str], name: str = "feature_name", **more: Sequence[str]) -> DataFrame:
    """position and name of every column, and more texts per column, in the session of ``df``."""
    lists = {name: names, **more}
    arrays = [f"array({', '.join(map(text_literal, texts))}) AS {title}" for title, texts in lists.items()]
    zipped = f"posexplode(arrays_zip({', '.join(lists)}))"
    table = df.sparkSession.range(1).selectExpr(*arrays).select(F.expr(zipped).alias(POSITION, "texts"))
    return table.select(POSITION, *[F.col(f"texts.{title}") for title in lists])


def named(stats: DataFrame, names: Sequence[str], name: str = "feature_name") -> DataFrame:
    """Replace the position by the name; the table of names is as small as the schema."""
    joined = stats.join(F.broadcast(names_table(stats, names, name)), POSITION)
    return joined.select(name, *[column for column in stats.columns if column != POSITION])
