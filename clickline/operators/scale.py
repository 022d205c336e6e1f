"""Scale-up of a table by copying its rows under new user ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scale_up(df: DataFrame, copies: int, user: str = "customer_id", also: tuple[str, ...] = ()) -> DataFrame:
    """Each row ``copies`` times with ``_1`` .. ``_copies`` appended to the user id.

    Other columns repeat as they are, order ids included; name columns in ``also`` to suffix
    them too (as text). A null id stays null.
    """
    copied = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    suffixed = {
        c: F.concat(F.col(c).cast("string"), F.lit("_"), F.col("_copy").cast("string")) for c in (user, *also)
    }
    return copied.withColumns(suffixed).drop("_copy")
