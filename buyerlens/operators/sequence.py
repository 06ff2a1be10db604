"""Order number and previous order within each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.session import scratch_path

_CUSTOMER = "customer_unique_id"
_STAMP = "order_purchase_timestamp"
_CHUNK = "__chunk"
_POSITION = "__position"


def order_sequence(amounts: DataFrame, chunks: int | None = None) -> DataFrame:
    """Number each customer's orders by time (ties by order id) and add the previous amount and date.

    A window over the customer alone would put a customer with a third of all
    orders into one task. The orders are therefore range-partitioned on the
    whole sort key, which may cut one customer into several consecutive chunks,
    and each chunk is numbered by itself. What a chunk needs from the chunks
    before it concerns only its first customer: the orders skipped, and the last order
    seen. So one boundary row per chunk is folded, however many customers there are.

    The numbered chunks are written to the shared folder, since the boundary rows and
    the result must come from the same chunks.
    """
    spark = amounts.sparkSession
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_chunk = Window.partitionBy(_CUSTOMER, _CHUNK).orderBy(_STAMP, "order_id")
    numbered = (
        amounts.repartitionByRange(chunks, _CUSTOMER, _STAMP, "order_id")
        .withColumn(_CHUNK, F.spark_partition_id())
        .select(
            "*",
            F.row_number().over(in_chunk).cast("bigint").alias(_POSITION),
            F.lag("order_amount").over(in_chunk).alias("previous_amount"),
            F.lag(_STAMP).over(in_chunk).alias("previous_purchase"),
        )
    )
    path = scratch_path(spark, "order-sequence")
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)

    last = F.max_by(F.struct(_CUSTOMER, _POSITION, "order_amount", _STAMP), F.struct(_CUSTOMER, _POSITION))
    boundaries = numbered.groupBy(_CHUNK).agg(F.min(_CUSTOMER).alias("first"), last.alias("last")).orderBy(_CHUNK).collect()
    carried = _carried(boundaries)
    if not carried:
        return numbered.select(*amounts.columns, F.col(_POSITION).alias("order_number"), "previous_amount", "previous_purchase")
    kinds = {f.name: f.dataType for f in amounts.schema}
    schema = T.StructType([
        T.StructField(_CHUNK, T.IntegerType()), T.StructField(_CUSTOMER, kinds[_CUSTOMER]), T.StructField("__skipped", T.LongType()),
        T.StructField("__amount", kinds["order_amount"]), T.StructField("__stamp", kinds[_STAMP]),
    ])
    joined = numbered.join(F.broadcast(spark.createDataFrame(carried, schema)), [_CUSTOMER, _CHUNK], "left")
    starts_chunk = F.col(_POSITION) == 1
    return joined.select(
        *amounts.columns,
        (F.col(_POSITION) + F.coalesce("__skipped", F.lit(0))).alias("order_number"),
        F.when(starts_chunk, F.col("__amount")).otherwise(F.col("previous_amount")).alias("previous_amount"),
        F.when(starts_chunk, F.col("__stamp")).otherwise(F.col("previous_purchase")).alias("previous_purchase"),
    )


def _carried(boundaries: list[Row]) -> list[tuple]:
    """(chunk, customer, orders skipped, last amount, last date) for each chunk that goes on with a customer.

    Each of ``boundaries``, in the order of the chunks, has the first customer and the last row of a chunk.
    """
    carried, before, skipped = [], None, 0
    for row in boundaries:
        if before is not None and row["first"] == before[_CUSTOMER]:
            carried.append((row[_CHUNK], row["first"], skipped, before["order_amount"], before[_STAMP]))
        else:
            skipped = 0
        last = row["last"]
        # A chunk of one customer adds to what came before; otherwise its last customer begins in it.
        skipped = last[_POSITION] + (skipped if last[_CUSTOMER] == row["first"] else 0)
        before = last
    return carried
