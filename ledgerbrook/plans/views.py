"""The given tables seen as bank entities, so that every query reads real tables.

Defects come from fixed remainders of the keys; nothing is random or left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Declared, so that opening a table runs no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
                   l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
                   l_linestatus string, l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def key(column: str, width: int) -> str:
    """SQL for a number as text, padded with zeros to a width; a longer number keeps all its digits."""
    digits = f"cast({column} as string)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def branches(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        f"concat('BRN-', {key('n_nationkey', 4)}) branch_id",
        "concat(' ', n_name, ' Main Branch ') branch_name",
        "n_name city",
        "r_name state",
        """case n_nationkey % 5 when 0 then 'Urban' when 1 then 'Semi-Urban' when 2 then 'Rural'
           when 3 then 'Metro' else 'Corporate' end branch_type""",
    )


def merchants(spark: SparkSession, d: str) -> DataFrame:
    supplier, nation = table(spark, d, "supplier"), table(spark, d, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        f"concat('MER-', {key('s_suppkey', 5)}) merchant_id",
        "concat(' ', s_name, ' ') merchant_name",
        """case s_suppkey % 10 when 0 then 'Grocery' when 1 then 'Travel' when 2 then 'Restaurant'
           when 3 then 'Electronics' when 4 then 'Healthcare' when 5 then 'Education'
           when 6 then 'Entertainment' when 7 then 'Fuel' when 8 then 'Shopping'
           else 'Utilities' end merchant_category""",
        "n_name city",
    )


def customers(spark: SparkSession, d: str) -> DataFrame:
    customer, nation, region = (table(spark, d, t) for t in ("customer", "nation", "region"))
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return joined.selectExpr(
        f"""case when c_custkey % 101 = 100 then null
           else concat('CUST-', {key('c_custkey', 7)}) end customer_id""",
        "case when c_custkey % 89 = 88 then null else concat(' ', c_name, ' ') end name",
        """cast(case when c_custkey % 53 = 52 then 5 + c_custkey % 13
           else 18 + c_custkey % 63 end as string) age""",
        "case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Other' end gender",
        "n_name city",
        "r_name state",
        "cast(cast(c_acctbal * 30 as decimal(15,2)) as string) income",
        "cast(date_add(date'2015-01-01', cast(c_custkey % 3400 as int)) as string) account_open_date",
        """case c_mktsegment when 'BUILDING' then 'Regular' when 'AUTOMOBILE' then 'Premium'
           when 'FURNITURE' then 'High Net Worth' when 'HOUSEHOLD' then 'Student'
           else 'Senior' end customer_segment""",
    )


def accounts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        f"concat('ACC-', {key('c_custkey', 7)}) account_id",
        f"concat('CUST-', {key('c_custkey', 7)}) customer_id",
        "case c_custkey % 3 when 0 then 'Savings' when 1 then 'Current' else 'Salary' end account_type",
        f"concat('BRN-', {key('c_nationkey', 4)}) branch_id",
        "cast(cast(c_acctbal as decimal(15,2)) as string) balance",
        """case when c_custkey % 67 = 66 then 'UNKNOWN' when c_custkey % 20 = 0 then ' BLOCKED '
           when c_custkey % 20 = 1 then 'CLOSED' else 'ACTIVE' end account_status""",
    )


def tx_bulk(spark: SparkSession, d: str) -> DataFrame:
    """Raw transactions, all text but the ingestion time; one per order line."""
    lineitem, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        """case when l_orderkey % 211 = 210 then null
           else concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) end transaction_id""",
        f"""case when l_orderkey % 97 = 96 then 'ACC-INVALID-999999'
           else concat('ACC-', {key('o_custkey', 7)}) end account_id""",
        """case l_linenumber % 8 when 0 then 'UPI' when 1 then 'CARD' when 2 then 'ATM' when 3 then 'NEFT'
           when 4 then 'IMPS' when 5 then 'RTGS' when 6 then 'CASH_DEPOSIT'
           else 'CASH_WITHDRAWAL' end transaction_type""",
        """cast(cast(case when l_orderkey % 83 = 82 then -l_extendedprice else l_extendedprice end
           as decimal(15,2)) as string) amount""",
        "cast(cast(l_shipdate as date) as string) `timestamp`",
        f"concat('MER-', {key('l_suppkey', 5)}) merchant_id",
        "concat('CITY-', cast(l_partkey % 50 as string)) location",
        "case l_returnflag when 'R' then 'Card' when 'A' then 'Wallet' else 'Transfer' end payment_method",
        "case o_orderstatus when 'F' then 'FAILED' when 'P' then 'PENDING' else 'SUCCESS' end status",
        """case substring(o_orderpriority, 1, 1) when '1' then 'Mobile' when '2' then 'Internet Banking'
           when '3' then 'ATM' when '4' then 'Branch' else 'Online' end channel""",
        "l_shipdate ingestion_timestamp",
    )


def tx_events(spark: SparkSession, d: str) -> DataFrame:
    """Typed transactions with times to the microsecond, for the window rules."""
    return table(spark, d, "events").selectExpr(
        f"concat('TXN-', {key('event_id', 10)}) transaction_id",
        f"concat('ACC-', {key('user_id', 7)}) account_id",
        "cast(value as decimal(15,2)) amount",
        "ts transaction_timestamp",
        "case event_type when 'error' then 'FAILED' when 'signup' then 'PENDING' else 'SUCCESS' end status",
        "concat('CITY-', cast(cast(get_json_object(props, '$.k') as int) % 5 as string)) location",
        "ts ingestion_timestamp",
    )
