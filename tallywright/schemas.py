"""Fixed schemas of the tables this library reads and writes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

CARD_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# The feed as delivered: the timestamp is still text.
CARD_FEED = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in CARD_TRANSACTIONS
    ]
)

# The columns of the transaction table.
TRANSACTIONS_BRONZE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("is_card_present", T.BooleanType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("ingestion_batch_id", T.StringType()),
        T.StructField("payload_hash", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("processing_date", T.DateType()),
    ]
)

EXPECTATION_RESULT = T.StructType(
    [
        T.StructField("expectation", T.StringType()),
        T.StructField("checked_rows", T.LongType()),
        T.StructField("failed_rows", T.LongType()),
        T.StructField("success", T.BooleanType()),
    ]
)


#: What the given tables must hold at least; other columns may stand beside these.
GIVEN_TABLES = {
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "customer": {"c_custkey": "bigint", "c_acctbal": "double"},
    "lineitem": {
        "l_orderkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_discount": "double",
        "l_shipdate": "timestamp_ntz",
    },
}


class SchemaError(ValueError):
    """A table does not have the columns it is read for."""


def require_columns(found: T.StructType, wanted: Mapping[str, str], label: str) -> None:
    """Raise unless ``found`` has every wanted column in its type."""
    types = {f.name: f.dataType.simpleString() for f in found}
    wrong = [f"{n} {types.get(n, 'missing')} instead of {t}" for n, t in wanted.items() if types.get(n) != t]
    if wrong:
        raise SchemaError(f"{label}: {', '.join(wrong)}")


def column_ddl(schema: T.StructType) -> str:
    """The column list of a CREATE TABLE statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
