"""Keep an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """The value as a generator column; one per ``select``.

    Filters on an ordinary computed column, including the null tests the optimizer infers
    from joins, are pushed below it and compute it again.  They stop at a generator, which
    adds no shuffle and stays inside the compiled stage.
    """
    return F.explode(F.array(value))
