"""Readers for the driver's parquet tables and the fixtures derived from them.

All fixtures are lazy projections/joins of the given tables (FIXTURES.md part 2),
so their size grows with the scale factor. Column pruning and filters reach the
parquet scan through Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import flatten_array
from ..specs import TableSpec

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

MONEY = "decimal(18,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Expose the tables as temporary views."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


class Tables:
    """Lazy accessors for the driver tables and derived fixtures of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- fact tables -------------------------------------------------------
    def txn_orders(self) -> DataFrame:
        """Sparse transactions, one per order (about ten per account)."""
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            F.to_date("o_orderdate").alias("txn_date"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            (F.col("o_orderpriority") == "1-URGENT").alias("label"),
            (F.col("o_orderstatus") != "P").alias("card_present"),
        )

    def txn_lines(self) -> DataFrame:
        """Transactions with a merchant: one per line item (ids repeat, H12)."""
        li = self.raw("lineitem")
        o = self.raw("orders")
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
        return j.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("l_suppkey").alias("merchant_id"),
            F.to_date("o_orderdate").alias("txn_date"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.col("l_linenumber").alias("pos_entry_mode"),
            (F.col("l_returnflag") == "R").alias("label"),
            (F.col("l_linestatus") == "F").alias("card_present"),
        )

    def txn_events(self) -> DataFrame:
        """Dense purchase events (a month, many per user per day)."""
        e = self.raw("events").where(F.col("event_type") == "purchase")
        return e.select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("account_id"),
            F.col("ts"),
            F.to_date("ts").alias("txn_date"),
            F.col("value").cast(MONEY).alias("amount"),
        )

    # -- dimensions --------------------------------------------------------
    def merchants(self) -> DataFrame:
        """Type-1 dimension with gaps: every tenth supplier is absent (H8)."""
        s = self.raw("supplier").where(F.pmod(F.col("s_suppkey"), F.lit(10)) != 0)
        return s.select(F.col("s_suppkey").alias("merchant_id"),
                        F.col("s_name").alias("merchant_name"),
                        F.col("s_nationkey").cast("bigint").alias("merchant_zone"))

    def accounts_scd2(self) -> DataFrame:
        """Type-2 dimension, 1-3 versions per account (flatten of array<struct>, U1)."""
        return accounts_scd2(self.raw("customer"))

    def profile_changes(self) -> DataFrame:
        """Change log to build an SCD-2 from (signup events carry a new zip)."""
        e = self.raw("events").where(F.col("event_type") == "signup")
        return e.select(
            F.col("event_id").alias("change_id"),
            F.col("user_id").alias("account_id"),
            F.col("ts").alias("changed_at"),
            F.get_json_object("props", "$.k").cast("bigint").alias("zip"),
        )

    # -- spines ------------------------------------------------------------
    def eol(self) -> DataFrame:
        """Entity-observation-label spine of card-present lines."""
        return eol_spine(self.txn_lines())


SPECS = {
    "accounts_scd2": TableSpec("account_id", time_key="valid_from", not_null=("account_id", "valid_from")),
    "merchants": TableSpec("merchant_id", not_null=("merchant_id",)),
    "rollups": TableSpec("account_id", time_key="date", not_null=("account_id", "date")),
    "txn_lines": TableSpec("transaction_id", not_null=("transaction_id",)),
}


def accounts_scd2(customer: DataFrame) -> DataFrame:
    """Versions v = 0..(custkey % 3) of each customer, chained by position.

    valid_from = 1995-01-01 plus 0 days for v = 0, else v*700 + custkey % 97;
    zone = (nationkey + 7v) % 25; valid_to = next valid_from, open for the last.
    The versions are built as an array of structs per row, then exploded and
    flattened (the reference's row-function-then-explode pattern, U1, P2).
    """
    base = F.lit("1995-01-01").cast("date")
    k = F.col("c_custkey")

    def start(v):
        return F.date_add(base, F.when(v == 0, F.lit(0)).otherwise(v * 700 + F.pmod(k, F.lit(97))).cast("int"))

    n = F.pmod(k, F.lit(3))
    versions = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n),
        lambda v: F.struct(
            v.alias("version"),
            start(v).alias("valid_from"),
            F.when(v < n, start(v + 1)).alias("valid_to"),
            F.pmod(F.col("c_nationkey") + 7 * v, F.lit(25)).cast("bigint").alias("zone"),
        ),
    )
    rows = customer.select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"),
                           versions.alias("versions"))
    flat = flatten_array(rows, "versions", keep=["account_id", "account_name"])
    return flat.withColumn("is_current", F.col("valid_to").isNull().cast("bigint"))


def eol_spine(txn: DataFrame) -> DataFrame:
    """``select transaction_id, bigint(account), bigint(merchant), date as
    observation_date, label, amount from txn where card_present``."""
    return txn.where(F.col("card_present")).select(
        "transaction_id",
        F.col("account_id").cast("bigint").alias("primary_account_number"),
        F.col("merchant_id").cast("bigint").alias("merchant_id"),
        F.col("txn_date").alias("observation_date"),
        F.col("label"),
        F.col("amount").cast("double").alias("amount"),
    )
