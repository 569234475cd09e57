"""The credit panel: a per-client table derived from the order/line-item tables.

Each customer's seven newest orders play the months: the newest feeds only the
label, the next six are months 1..6 (newest first). Money is summed in integer
cents so the result does not depend on summation order.

Plan shape (designed for very large ``lineitem``):

1. ``lineitem`` is pruned to five columns and pre-aggregated per ``l_orderkey``
   (partial + final hash aggregate, so a hot order key is combined map-side).
2. The per-order aggregate is joined to ``orders`` on the order key; the
   aggregate's output partitioning is reused, so only ``orders`` is shuffled.
3. ``row_number() <= 7`` per customer is planned as a *window group limit*
   (partial top-7 before the shuffle), so a customer with a huge share of all
   orders still ships at most 7 rows per map partition.
4. The six months are pivoted with one grouped aggregate, then joined to
   ``customer`` (sort-merge or AQE broadcast — decided at run time by size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import config

REF_DATE = "1998-04-15"  # FIXED VALUE: day the payment lag is measured from


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(c):
    return F.round(c * 100).cast("bigint")


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its payment code, bill and payment (cents-exact)."""
    li = (
        read_table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
        .where(F.col("l_orderkey").isNotNull())
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.when(F.col("l_linestatus") == "F", _cents(F.col("l_extendedprice"))))
            .alias("pay_c"),
            F.sum(F.when(F.col("l_returnflag") == "R", _cents(F.col("l_extendedprice"))))
            .alias("ret_c"),
            F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("n_paid"),
            F.sum(F.datediff(F.col("l_shipdate").cast("date"), F.lit(REF_DATE).cast("date")))
            .alias("lag_days"),
        )
    )
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0))
    lag = F.coalesce(F.col("lag_days"), F.lit(0))
    n_paid = F.coalesce(F.col("n_paid"), F.lit(0))
    code = (
        F.when(n_lines == 0, F.lit(-2))
        .when(lag > 200 * n_lines,
              F.least(F.lit(9), F.floor(lag / (200 * n_lines)).cast("int")))
        .when(n_paid == n_lines, F.lit(-1))
        .otherwise(F.lit(0))
    ).cast("int")
    return j.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
        (F.coalesce(F.col("pay_c"), F.lit(0)) / F.lit(100.0)).alias("pay_amt"),
        ((_cents(F.col("o_totalprice")) - F.coalesce(F.col("ret_c"), F.lit(0)))
         / F.lit(100.0)).alias("bill_amt"),
        code.alias("code"),
    )


def credit_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client table: ID, 23 features in the fixed order, label."""
    m = order_months(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(),
                                                F.col("o_orderkey").desc())
    st = m.withColumn("k", F.row_number().over(w)).where(F.col("k") <= 7)

    def at(k, c):
        return F.max(F.when(F.col("k") == k, F.col(c)))

    aggs = [at(1, "code").alias("c1"), at(1, "o_orderpriority").alias("pr")]
    aggs += [at(k + 2, "code").alias(p) for k, p in enumerate(config.PAY_COLS)]
    aggs += [at(k + 2, "bill_amt").alias(b) for k, b in enumerate(config.BILL_COLS)]
    aggs += [at(k + 2, "pay_amt").alias(p) for k, p in enumerate(config.PAY_AMT_COLS)]
    wide = st.groupBy("o_custkey").agg(*aggs)

    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    j = wide.join(cust, wide.o_custkey == cust.c_custkey, "inner")
    label = F.when((F.col("c1") >= 3) | ((F.col("PAY_0") >= 1) & (F.col("pr") < "4")), 1) \
        .otherwise(0).cast("int")
    return j.select(
        F.col("o_custkey").alias("ID"),
        (F.col("c_acctbal") * 50).alias("LIMIT_BAL"),
        (1 + F.col("o_custkey") % 2).cast("int").alias("SEX"),
        (F.col("c_nationkey") % 7).cast("int").alias("EDUCATION"),
        (F.col("o_custkey") % 4).cast("int").alias("MARRIAGE"),
        (21 + F.col("o_custkey") % 50).cast("int").alias("AGE"),
        *config.PAY_COLS, *config.BILL_COLS, *config.PAY_AMT_COLS,
        label.alias("label"),
    )


def development(panel: DataFrame) -> DataFrame:
    """Labelled rows (``ID % 5 != 4``)."""
    return panel.where(F.col("ID") % 5 != 4)


def evaluation(panel: DataFrame) -> DataFrame:
    """Unlabelled rows (``ID % 5 == 4``), label dropped."""
    return panel.where(F.col("ID") % 5 == 4).drop("label")
