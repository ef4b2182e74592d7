"""Joins of many pairs with the rows of one of their ends, where far more rows result than go in.

Pairs are dealt to parts in the order of their key. A part gets one copy of each row that
any of its pairs meets, so what moves is pairs and copies, and what results is made in the
part and stays there: it can be summed up or sorted in place, and the parts one after
the other are in the order of the pairs. Ends that many pairs share are what
makes the result large, and these are copied once a part, not once a pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise

# Fixed value: rows a part, so that a task holds those beside its pairs and sorts what the pairs yield.
ROWS_A_PART = 100_000


class Parts:
    """Pairs with distinct ``key``, stored with ``part``, their part, and ``at``, which numbers them in the order of ``key``.

    ``beside`` are rows of the first columns of ``key`` that tasks hold beside their pairs; they count for
    the size of a part as pairs do.
    """

    def __init__(self, pairs: DataFrame, key: list[str], beside: DataFrame):
        least = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.number = max(least, -(-(pairs.count() + beside.count()) // ROWS_A_PART))
        both = pairs.withColumn("pair", F.lit(True)).unionByName(
            beside.withColumn("pair", F.lit(False)), allowMissingColumns=True
        )
        ordered = both.repartitionByRange(self.number, *key).sortWithinPartitions(*key)
        numbered = ordered.withColumn("at", F.monotonically_increasing_id()).where("pair").drop("pair")
        self.stored = materialise(numbered.withColumn("part", F.shiftright("at", 33).cast("int")))

    def pairs(self) -> DataFrame:
        """The pairs, each in its part."""
        return self._dealt(self.stored)

    def copies(self, rows: DataFrame, on: list[str]) -> DataFrame:
        """``rows`` in every part that has a pair with their values of ``on``, once a part.

        A join with the pairs by ``part`` and other columns moves nothing. No side of the
        join made here is broadcast, as either grows with the pairs.
        """
        wanted = self.stored.select("part", *on).distinct()
        return self._dealt(wanted.join(rows.hint("merge"), on))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartitionById(self.number, "part")
