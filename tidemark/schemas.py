"""Record layouts of the delimited inputs, in field order, times still as epoch numbers."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed: the order of the fields is that of the inputs.
USER_BEHAVIOR = (
    T.StructType()
    .add("user_id", T.LongType())
    .add("item_id", T.LongType())
    .add("category_id", T.IntegerType())
    .add("behavior", T.StringType())
    .add("epoch", T.LongType())
)
MARKETING_BEHAVIOR = (
    T.StructType()
    .add("user_id", T.StringType())
    .add("behavior", T.StringType())
    .add("channel", T.StringType())
    .add("epoch", T.LongType())
)
AD_CLICK = (
    T.StructType()
    .add("user_id", T.LongType())
    .add("ad_id", T.LongType())
    .add("province", T.StringType())
    .add("city", T.StringType())
    .add("epoch", T.LongType())
)
LOGIN = (
    T.StructType()
    .add("user_id", T.LongType())
    .add("ip", T.StringType())
    .add("status", T.StringType())
    .add("epoch", T.LongType())
)
ORDER = (
    T.StructType()
    .add("order_id", T.LongType())
    .add("event_type", T.StringType())
    .add("tx_id", T.StringType())
    .add("epoch", T.LongType())
)
RECEIPT = (
    T.StructType()
    .add("tx_id", T.StringType())
    .add("pay_channel", T.StringType())
    .add("epoch", T.LongType())
)
