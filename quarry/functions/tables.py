"""Tables inside documents: rows of cells as text and Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))


def to_text(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, " | ")), "\n")


def header_inferred(rows: Column) -> Column:
    """One row alone is a header, and so is a first row without empty cells."""
    first = F.try_element_at(rows, F.lit(1))
    return F.when(F.size(rows) == 0, F.lit(False)).otherwise((F.size(rows) == 1) | F.forall(first, lambda c: F.trim(c) != ""))


def to_markdown(rows: Column) -> Column:
    """The first row as header; short rows padded; bars escaped, line ends as spaces."""
    wide = width(rows)

    def line(row: Column) -> Column:
        padded = F.concat(row, F.array_repeat(F.lit(""), F.greatest(wide - F.size(row), F.lit(0)).cast("int")))
        cells = F.transform(padded, lambda c: F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|")))
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), wide), " | "), F.lit(" |"))
    lines = F.concat(F.array(line(F.element_at(rows, 1)), rule), F.transform(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), line))
    return F.when(F.size(rows) > 0, F.array_join(lines, "\n")).otherwise(F.lit(""))
