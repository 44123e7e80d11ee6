"""Text compared without regard to case (E-07, G-02, G-03, G-07, G-12).

A row store's usual collation takes spellings that differ in case for one value. Here the
dimension is folded instead of every plan: each value becomes the least spelling of its
collated group, so grouping, joining, ranking and sorting on it agree everywhere after.
Only the dimension is read; the facts keep meeting it by id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.operators.joins import small
from saleslens.session import materialize

IGNORE_CASE = "UTF8_LCASE"


def fold_spellings(df: DataFrame, attrs: Sequence[str], collation: str = IGNORE_CASE) -> DataFrame:
    """``df`` with every value of ``attrs`` spelled as the least (in binary order) of the
    values that the collation holds equal. Nulls stay null; other columns as they are.

    Per attribute one row per distinct value; where few values have many rows each (a
    category), the written table of spellings is small and broadcast, so they do not
    shuffle by value.
    """
    out = df
    for c in attrs:
        values = df.where(F.col(c).isNotNull()).select(c).distinct()
        spelled = materialize(values.groupBy(F.collate(c, collation).alias("_same")).agg(
            F.collect_set(c).alias("_all"), F.min(c).alias("_least")), "spellings")
        # values join by their own bytes; only spellings that change are looked up
        changes = spelled.select("_least", F.explode("_all").alias("_value")).where("_value <> _least")
        changes = small(materialize(changes.select("_value", "_least"), "respelled"))
        out = out.join(changes, out[c] == changes["_value"], "left").withColumn(c, F.coalesce("_least", c)).drop("_value", "_least")
    return out
