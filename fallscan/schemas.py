"""Explicit schemas of every input, so that no read ever infers one.

Besides being safer, a declared schema saves the extra job Spark otherwise runs
to look at file footers.
"""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---- inputs of the library ------------------------------------------------------

BARS = _struct(
    ticker=T.StringType(),
    trade_date=T.DateType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    adj_close=T.DoubleType(),
    volume=T.LongType(),
)

#: The price fields of a bar, in the order in which a wide panel lists them.
PRICE_FIELDS = ("open", "high", "low", "close", "adj_close")
BAR_FIELDS = PRICE_FIELDS + ("volume",)

LISTING = _struct(
    ticker=T.StringType(),
    security_name=T.StringType(),
    other_info=T.StringType(),
    market=T.StringType(),
    test_issue=T.StringType(),
    financial_status=T.StringType(),
)

COMPANIES = _struct(
    ticker=T.StringType(),
    name=T.StringType(),
    sector=T.StringType(),
    industry=T.StringType(),
)

# ---- driver tables the registered queries read ----------------------------------

EVENTS = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

CUSTOMER = _struct(
    c_custkey=T.LongType(),
    c_name=T.StringType(),
    c_nationkey=T.IntegerType(),
    c_acctbal=T.DoubleType(),
    c_mktsegment=T.StringType(),
)

NATION = _struct(
    n_nationkey=T.IntegerType(),
    n_name=T.StringType(),
    n_regionkey=T.IntegerType(),
)

REGION = _struct(r_regionkey=T.IntegerType(), r_name=T.StringType())

ORDERS = _struct(
    o_orderkey=T.LongType(),
    o_custkey=T.LongType(),
    o_orderstatus=T.StringType(),
    o_totalprice=T.DoubleType(),
    o_orderdate=T.TimestampNTZType(),
    o_orderpriority=T.StringType(),
)

SUPPLIER = _struct(
    s_suppkey=T.LongType(),
    s_name=T.StringType(),
    s_nationkey=T.IntegerType(),
    s_acctbal=T.DoubleType(),
)

LINEITEM = _struct(
    l_orderkey=T.LongType(),
    l_partkey=T.LongType(),
    l_suppkey=T.LongType(),
    l_linenumber=T.IntegerType(),
    l_quantity=T.DoubleType(),
    l_extendedprice=T.DoubleType(),
    l_discount=T.DoubleType(),
    l_tax=T.DoubleType(),
    l_returnflag=T.StringType(),
    l_linestatus=T.StringType(),
    l_shipdate=T.TimestampNTZType(),
)

DRIVER_TABLES = {
    "events": EVENTS,
    "customer": CUSTOMER,
    "nation": NATION,
    "region": REGION,
    "orders": ORDERS,
    "supplier": SUPPLIER,
    "lineitem": LINEITEM,
}
