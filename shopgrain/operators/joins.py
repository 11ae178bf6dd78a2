"""Left joins that stay even when one key holds a large share of the rows.

At run time Spark cuts the partition of a hot key into pieces and joins each
of them to a copy of the matching partition, but only where both inputs of the
join are plain shuffles.  An aggregate or another join between shuffle and
join blocks the cut.  `own_shuffle` removes that obstacle for one more shuffle
of the smaller side, and the left side moves once however hot its keys are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.operators.rollups import (
    order_facts,
    postal_centres,
    review_totals,
)


def own_shuffle(df: DataFrame, key: str) -> DataFrame:
    """The same rows, with a text key the planner takes for a new column.

    Joining on it shuffles this side anew instead of building on how an
    aggregate or join below happens to be partitioned.
    """
    return df.withColumn(key, F.concat(F.col(key)))


def order_context(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Status flags, delivery and review figures of every known order id.

    Either side may lack an order.  A full join leaves its merged key without
    a known partitioning, so what is joined to it is free to be split.  Rows of
    an order id that is there more than once are numbered by `nth`, in the
    order in which the join sorts them anyway.
    """
    nth = F.row_number().over(Window.partitionBy("order_id").orderBy("order_id"))
    facts = order_facts(orders).withColumn("nth", nth)
    return facts.join(review_totals(reviews), "order_id", "full")


def with_coordinates(
    df: DataFrame, postal: str, geolocations: DataFrame
) -> DataFrame:
    """Add the mean coordinates of each row's postal code.

    The lookup is broadcast when its size, measured at run time, is below the
    session's threshold; beyond that it is a shuffle join that can be split.
    """
    centres = postal_centres(geolocations).withColumnRenamed("geo_postal_code", postal)
    return df.join(own_shuffle(centres, postal), postal, "left")
