"""Tables bucketed by customer: features, the weak-signal join and the sample join need no exchange on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ebbtide.config import ID

BUCKETS = 64


def write_by_customer(df: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` at ``path`` as a table with the rows of a customer in one bucket, sorted; gives the table.

    Rows are brought together by the same hash first, so each bucket is one file. Tables that are to be joined need the same number
    of buckets. A customer with very many rows makes its bucket large; choose the number for the size of the table.
    """
    placed = df.repartition(buckets, ID)
    placed.write.mode("overwrite").bucketBy(buckets, ID).sortBy(ID).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
