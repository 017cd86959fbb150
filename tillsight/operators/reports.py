"""Business reports over the sales fact, the snapshot and the score fact.

Averages are exact sums divided by counts; averages of per-customer ratios
(AOV, margin, promo rate) are rounded to the precision the warehouse reports
use (2 decimals for money, 6 for ratios).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as K


def _mean(c: str) -> Column:
    return F.sum(F.col(c).cast("double")) / F.count(F.col(c))


def _exact_mean(c: str) -> Column:
    """Mean of an integer or decimal column: exact sum, one division."""
    return F.sum(F.col(c)).cast("double") / F.count(F.col(c)).cast("double")


def _ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def churn_list(scored: DataFrame) -> DataFrame:
    """Risk list: highest probability first, then longest recency, then name."""
    return (scored.select("customer_name", "segment", "recency", "frequency", "aov", "margin", "trend",
                          "active_months", "risk_score", "churn_prob", "risk_level", "sales_action")
            .orderBy(F.col("churn_prob").desc(), F.col("recency").desc_nulls_last(), "customer_name"))


def churn_by_segment(scored: DataFrame) -> DataFrame:
    """Per segment (null kept): customers, mean probability, urgent and high counts, means."""
    return (scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        _mean("churn_prob").alias("mean_churn_prob"),
        F.count_if(F.col("risk_level") == K.LEVEL_URGENT).alias("urgent_customers"),
        F.count_if(F.col("risk_level").isin(K.LEVEL_HIGH, K.LEVEL_URGENT)).alias("high_or_urgent"),
        _exact_mean("recency").alias("avg_recency"),
        F.round(_mean("aov"), 2).alias("avg_aov"),
        F.round(_mean("margin"), 6).alias("avg_margin"),
    ).orderBy(F.col("mean_churn_prob").desc(), "segment"))


def rfm_summary(snapshot: DataFrame) -> DataFrame:
    """Per segment: customers and mean recency, frequency, AOV, margin, promo rate."""
    return (snapshot.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        _exact_mean("recency").alias("avg_recency"),
        _exact_mean("frequency").alias("avg_frequency"),
        F.round(_mean("aov"), 2).alias("avg_aov"),
        F.round(_mean("margin"), 6).alias("avg_margin"),
        F.round(_mean("promo_rate"), 6).alias("avg_promo_rate"),
    ).orderBy(F.col("avg_recency").desc(), "segment"))


def monthly_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per calendar month: lines, distinct customers, revenue, profit, margin.

    The join is left to adaptive execution, which broadcasts the date dimension only at a checked size.
    """
    f = fact.join(dim_date.select("date_key", "year_number", "month_number", "year_month"), "date_key")
    return (f.groupBy("year_number", "month_number", "year_month").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_distinct("customer_key").alias("customer_count"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("profit").cast("double").alias("profit"),
        _ratio(F.sum("profit"), F.sum("revenue")).alias("margin"),
    ).orderBy("year_number", "month_number"))


def customer_totals(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per customer: lines, revenue, profit, margin (fact pre-aggregated before the join)."""
    per = fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("revenue").alias("_rev"), F.sum("profit").alias("_prof"))
    return (per.join(dim_customer.select("customer_key", "customer_name", "current_segment"), "customer_key")
            .select("customer_name", "current_segment", "transaction_count",
                    F.col("_rev").cast("double").alias("revenue"),
                    F.col("_prof").cast("double").alias("profit"),
                    _ratio(F.col("_prof"), F.col("_rev")).alias("margin")))


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` customers by revenue (ties by name). Spark plans TakeOrderedAndProject:
    each task keeps its own top n, so only n rows per task reach the final merge."""
    return customer_totals(fact, dim_customer).orderBy(F.col("revenue").desc(), "customer_name").limit(n)


def reconciliation(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Row count and money of staging against the fact."""
    def summary(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("source_name"), F.count(F.lit(1)).alias("row_count"),
                      F.sum("revenue").cast("double").alias("revenue"),
                      F.sum("profit").cast("double").alias("profit"))
    return summary(staged, "staging").unionByName(summary(fact, "fact"))


def reconciliation_by_batch(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Per load batch: staged against fact rows and revenue, with differences."""
    s = staged.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("staged_rows"),
                                            F.sum("revenue").alias("_sr"))
    f = fact.groupBy("load_batch_id").agg(F.count(F.lit(1)).alias("fact_rows"),
                                          F.sum("revenue").alias("_fr"))
    j = s.join(f, "load_batch_id", "full_outer")
    z = F.lit(0)
    return j.select("load_batch_id",
                    F.coalesce("staged_rows", z).alias("staged_rows"),
                    F.coalesce("fact_rows", z).alias("fact_rows"),
                    (F.coalesce("staged_rows", z) - F.coalesce("fact_rows", z)).alias("row_difference"),
                    (F.coalesce("_sr", z) - F.coalesce("_fr", z)).cast("double").alias("revenue_difference"))


def load_audit(staged: DataFrame) -> DataFrame:
    """Per load batch and file: rows, revenue, first/last sale date, status."""
    return staged.groupBy("load_batch_id", "source_file_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    ).withColumn("status", F.when(F.col("row_count") > 0, "SUCCESS").otherwise("EMPTY"))


# ------------------------------------------------------------ dashboard queries

def sales_by_segment(sales: DataFrame) -> DataFrame:
    """Revenue and profit by segment at sale."""
    return sales.groupBy(F.col("segment_name").alias("segment")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("profit").cast("double").alias("profit"),
        _ratio(F.sum("profit"), F.sum("revenue")).alias("margin"))


def customer_share(dim_customer: DataFrame) -> DataFrame:
    """Customers per current segment and their share of all customers.

    The share window runs over the already aggregated rows (one per segment).
    """
    per = dim_customer.groupBy(F.col("current_segment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"))
    return per.withColumn("customer_share", F.col("customers").cast("double")
                          / F.sum("customers").over(Window.partitionBy()).cast("double"))


def customers_month_segment(sales: DataFrame) -> DataFrame:
    """Distinct buying customers per month and segment at sale."""
    return sales.groupBy(F.date_format("sale_date", "yyyy-MM").alias("year_month"),
                         F.col("segment_name").alias("segment")).agg(
        F.count_distinct("customer_name").alias("customers"))


def product_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_code").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("revenue").alias("_rev"), F.sum("profit").alias("_prof")).select(
        "product_code", "transaction_count",
        F.col("_rev").cast("double").alias("revenue"),
        F.col("_prof").cast("double").alias("profit"),
        F.coalesce(_ratio(F.col("_prof"), F.col("_rev")), F.lit(0.0)).alias("margin"))


def top_products_by_margin(sales: DataFrame, n: int = 5) -> DataFrame:
    return product_totals(sales).orderBy(F.col("margin").desc(), "product_code").limit(n)


def top_products_by_revenue(sales: DataFrame, n: int = 10) -> DataFrame:
    return product_totals(sales).orderBy(F.col("revenue").desc(), "product_code").limit(n)


# Shares of a segment's customers that are joined apart.
SALT = 32


def revenue_share(sales: DataFrame) -> DataFrame:
    """Per customer and segment: revenue, profit and share of the segment's revenue.

    Segment totals are a second aggregate of the per-customer rows (one row
    per segment), joined back on the segment and one of ``SALT`` shares of its
    customers, so a segment that holds most customers is spread over tasks.
    """
    per = sales.groupBy("customer_name", F.col("segment_name").alias("segment")).agg(
        F.sum("revenue").alias("_rev"), F.sum("profit").alias("_prof"))
    tot = per.groupBy("segment").agg(F.sum("_rev").alias("_seg_rev"))
    per = per.withColumn("_salt", F.pmod(F.xxhash64("customer_name"), F.lit(SALT)).cast("int"))
    tot = tot.select(F.col("segment").alias("_seg"), "_seg_rev",
                     F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_s"))
    return (per.join(tot, per.segment.eqNullSafe(F.col("_seg")) & (F.col("_salt") == F.col("_s")), "left")
            .select("customer_name", "segment",
                    F.col("_rev").cast("double").alias("revenue"),
                    F.col("_prof").cast("double").alias("profit"),
                    _ratio(F.col("_rev"), F.col("_seg_rev")).alias("revenue_share")))


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category_name").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("profit").cast("double").alias("profit"))
