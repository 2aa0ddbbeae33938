"""The SQL flavour of the extract job (M2) as SQL text over named views.

Every statement takes its input view and its constants as named parameters, so no text is put together
from values. The projection keeps the source's decimal for the tier test; money is summed as the exact
decimal, which the double total casts back to without loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise import model

PROJECTION = """
SELECT order_id, customer_id, order_status,
       CAST(order_total AS DOUBLE) AS order_total,
       item_count, product_category, created_at, delivery_date, is_loyalty_member, rating,
       CASE WHEN order_total < :low_below THEN 'low'
            WHEN order_total < :mid_below THEN 'mid'
            ELSE 'high' END AS revenue_tier,
       get_json_object(metadata, '$.device') AS device,
       get_json_object(metadata, '$.coupon_code') AS coupon_code,
       CAST(created_at AS DATE) AS order_date,
       COALESCE(rating, CAST(0 AS DECIMAL(3,1))) AS rating_safe,
       CAST(is_loyalty_member AS INT) AS loyalty_flag,
       shipping_address
FROM IDENTIFIER(:rows)"""

# This job's own gates: rows and totals. It has no gate on the status.
GATES = """
SELECT stack(2,
         'row_count', n, CAST(:min_rows AS BIGINT), n >= :min_rows,
         'bad_order_total', bad, CAST(0 AS BIGINT), bad = 0) AS (`check`, observed, threshold, passed)
FROM (SELECT count(*) AS n, count_if(order_total IS NULL OR order_total < 0) AS bad FROM IDENTIFIER(:rows))"""

STATUS_SHARE = """
SELECT order_status, count(*) AS cnt,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct
FROM IDENTIFIER(:rows)
GROUP BY order_status
ORDER BY cnt DESC, order_status NULLS LAST"""

TIER_REVENUE = """
SELECT revenue_tier, count(*) AS order_count,
       CAST(round(avg(total), 2) AS DOUBLE) AS avg_total,
       CAST(round(sum(total), 2) AS DOUBLE) AS total_revenue
FROM (SELECT revenue_tier, CAST(order_total AS DECIMAL(12,2)) AS total FROM IDENTIFIER(:rows))
GROUP BY revenue_tier
ORDER BY total_revenue DESC, revenue_tier"""

TOP_CATEGORIES = """
SELECT product_category, count(*) AS orders,
       CAST(round(avg(CAST(order_total AS DECIMAL(12,2))), 2) AS DOUBLE) AS avg_order_value,
       round(avg(rating_safe), 2) AS avg_rating
FROM IDENTIFIER(:rows)
GROUP BY product_category
ORDER BY orders DESC, product_category
LIMIT :k"""


def projection(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(PROJECTION, args={"rows": view, "low_below": model.TIER_LOW_BELOW, "mid_below": model.TIER_MID_BELOW})


def gates(spark: SparkSession, view: str, min_rows: int = model.MIN_ROWS) -> DataFrame:
    return spark.sql(GATES, args={"rows": view, "min_rows": min_rows})


def reports(spark: SparkSession, view: str, k: int = 10) -> dict[str, DataFrame]:
    return {
        "status_distribution": spark.sql(STATUS_SHARE, args={"rows": view}),
        "tier_breakdown": spark.sql(TIER_REVENUE, args={"rows": view}),
        "category_performance": spark.sql(TOP_CATEGORIES, args={"rows": view, "k": k}),
    }
