"""Transaction sources.

A transaction row holds 8 fields: transaction_id, product_id, description,
quantity, invoice_date, unit_price, customer_id, country. Quantity < 0 marks a
return.

``parse_transactions`` reads comma-separated lines without quoting (``csv``
would skip blank lines and honour quotes, changing results).
``transactions_from_tables`` derives the same relation from the TPC-H-like
tables: lineitem ⋈ orders ⋈ customer ⋈ nation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import java_comma_split
from ..plans.session import read_table

TXN_COLUMNS = ["transaction_id", "product_id", "description", "quantity",
               "invoice_date", "unit_price", "customer_id", "country"]


def parse_transactions(lines: DataFrame, on_error: str = "fail",
                       value_col: str = "value") -> DataFrame:
    """Typed transactions from raw lines.

    ``quantity`` is parsed for every row (a malformed quantity fails the job in
    ``fail`` mode, drops the row in ``drop`` mode). ``customer_id`` is parsed
    leniently here (NULL when malformed) and ``country`` is NULL when the row has
    fewer than 8 non-trailing-empty fields: whether that is an error depends on
    the filter, so :func:`pointlake.operators.baskets.purchases` decides.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    # a row of its own for the fields: a line is split once, not for each field and again in the filter
    lines = lines.select(F.col(value_col).alias("line"), F.explode(F.array(java_comma_split(value_col))).alias("fields"))
    t = F.col("fields")
    n = F.size(t)

    def field(i: int):
        return F.when(n > i, F.try_element_at(t, F.lit(i + 1)))

    quantity = F.try_element_at(t, F.lit(4)).try_cast("int")
    if on_error == "fail":  # explicit, so that it fails whatever the session's ANSI mode
        quantity = F.when(quantity.isNull(), F.raise_error(F.concat(F.lit("malformed transaction row: "), F.col("line")))) \
                    .otherwise(quantity)
    out = lines.select(
        field(0).alias("transaction_id"),
        field(1).alias("product_id"),
        field(2).alias("description"),
        quantity.alias("quantity"),
        field(4).alias("invoice_date"),
        field(5).try_cast("double").alias("unit_price"),
        field(6).try_cast("int").alias("customer_id"),
        field(7).alias("country"),
    )
    if on_error == "drop":
        out = out.filter(F.col("quantity").isNotNull())
    return out


def read_transactions(spark: SparkSession, path: str, on_error: str = "fail",
                      partitions: int | None = None) -> DataFrame:
    lines = spark.read.text(path)
    if partitions:
        lines = lines.repartition(int(partitions))
    return parse_transactions(lines, on_error)


def transactions_from_tables(spark: SparkSession, sf_dir: str, purchases_only: bool = False) -> DataFrame:
    """Transactions over the test tables.

    product = l_partkey, customer = o_custkey, country = n_name, and a returned
    line (l_returnflag = 'R') has negative quantity. Joins are declared from the
    small dimension outward; Spark broadcasts a side only when its measured size
    is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joins
    otherwise, so nothing unbounded is broadcast. ``purchases_only`` leaves rows
    whose quantity is not positive at the lineitem scan, as a predicate on its
    own columns that prunes row groups.
    """
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    if purchases_only:
        returned = F.col("l_returnflag") == "R"
        li = li.filter((returned & (F.col("l_quantity") <= -1)) |
                       ((F.col("l_returnflag").isNull() | ~returned) & (F.col("l_quantity") >= 1)))
    cust = c.join(n, c.c_nationkey == n.n_nationkey)
    orders = o.join(cust, o.o_custkey == cust.c_custkey)
    rows = li.join(orders, li.l_orderkey == orders.o_orderkey)
    qty = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")) \
           .otherwise(F.col("l_quantity")).cast("int")
    return rows.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("quantity"),
        F.col("o_custkey").alias("customer_id"),
        F.col("n_name").alias("country"),
    )


TXN_SQL = """
SELECT l.l_orderkey AS transaction_id, l.l_linenumber AS line_no,
       l.l_partkey AS product_id,
       CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS INTEGER)
         AS quantity,
       o.o_custkey AS customer_id, n.n_name AS country
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
