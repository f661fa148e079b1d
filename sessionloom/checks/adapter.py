"""The generated `events` table in the shape of shop events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.schema import RAW_COLUMNS

# Range used by the date-limited queries.
START, END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
# Where it is cut into two ranges: the end of the first and the start of the second.
MIDDLE = "2024-01-15 11:59:59", "2024-01-15 12:00:00"


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with repeat views, changing prices, null attributes, shared and null sessions."""
    k, day = F.col("k"), F.dayofmonth("ts").cast("string")
    product = k % 10
    columns = {
        "event_time": F.date_trunc("second", "ts").cast("timestamp_ntz"),
        "event_type": F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")),
        "product_id": product.cast("string"),
        "category_id": (k % 3).cast("string"),
        "category_code": F.when(product != 9, F.concat(F.lit("cat."), (product % 3).cast("string"))),
        "brand": F.when(product % 5 != 0, F.concat(F.lit("brand"), (product % 4).cast("string"))),
        "price": (product * 10 + F.floor(k / 50)).cast("double"),
        "user_id": F.col("user_id").cast("string"),
        "user_session": F.when(k == 7, F.concat(F.lit("shared-"), day)).when(
            k != 8,
            F.concat(
                F.lit("s-"), F.col("user_id").cast("string"),
                F.lit("-"), F.floor(F.dayofmonth("ts") / 3).cast("string"),
            ),
        ),
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # props is always {"k": n}.  Stripping it is far cheaper than a JSON parse, which Catalyst
    # would repeat in every filter pushed below this projection.
    return events.withColumn("k", F.btrim("props", F.lit('{"k: }')).cast("int")).select(
        [columns[name].alias(name) for name in RAW_COLUMNS]
    )
