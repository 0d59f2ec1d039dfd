"""Cleaned commerce tables. Only projections: every filter and column reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalars import blank_to_null, days_between, hours_between, title_case, zip_code


def orders(raw: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp").cast("timestamp")
    approved = F.col("order_approved_at").cast("timestamp")
    delivered = F.col("order_delivered_customer_date").cast("timestamp")
    promised = F.col("order_estimated_delivery_date").cast("timestamp")
    return raw.where(F.col("order_id").isNotNull()).select(
        "order_id",
        "customer_id",
        F.trim(F.lower("order_status")).alias("order_status"),
        bought.alias("purchased_at"),
        approved.alias("approved_at"),
        F.col("order_delivered_carrier_date").cast("timestamp").alias("shipped_at"),
        delivered.alias("delivered_at"),
        promised.alias("estimated_delivery_at"),
        # The flags read the status as landed, before trimming.
        (F.col("order_status") == "delivered").alias("is_delivered"),
        (F.col("order_status") == "canceled").alias("is_canceled"),
        days_between(delivered, bought).alias("days_to_deliver"),
        hours_between(approved, bought).alias("hours_to_approve"),
        days_between(promised, delivered).alias("delivery_delta_days"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    price = F.col("price").cast("decimal(10,2)")
    freight = F.col("freight_value").cast("decimal(10,2)")
    return raw.where(F.col("order_id").isNotNull()).select(
        "order_id",
        F.col("order_item_id").cast("int").alias("item_seq"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp").alias("shipping_limit_at"),
        price.alias("price"),
        freight.alias("freight_value"),
        (price + freight).alias("total_item_value"),
    )


def _place(raw: DataFrame, prefix: str, *ids: str, full_initcap: bool = False) -> DataFrame:
    return raw.where(F.col(ids[0]).isNotNull()).select(
        *ids,
        zip_code(F.col(f"{prefix}_zip_code_prefix")).alias("zip_code"),
        title_case(F.trim(F.col(f"{prefix}_city")), full_initcap).alias("city"),
        F.upper(F.trim(F.col(f"{prefix}_state"))).alias("state"),
    )


def customers(raw: DataFrame, full_initcap: bool = False) -> DataFrame:
    return _place(raw, "customer", "customer_id", "customer_unique_id", full_initcap=full_initcap)


def sellers(raw: DataFrame, full_initcap: bool = False) -> DataFrame:
    return _place(raw, "seller", "seller_id", full_initcap=full_initcap)


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with a display category where one is known.

    The translation has one row per category; AQE broadcasts it when its measured size allows.
    """
    sides = ["length", "height", "width"]
    named = raw.where(F.col("product_id").isNotNull()).join(translation, "product_category_name", "left")
    volume = F.lit(1)
    for side in sides:
        volume = volume * F.col(f"product_{side}_cm").cast("int")
    return named.select(
        "product_id",
        F.col("product_category_name").alias("category_pt"),
        F.coalesce("product_category_name_english", "product_category_name").alias("category"),
        F.col("product_name_lenght").cast("int").alias("name_length"),
        F.col("product_description_lenght").cast("int").alias("description_length"),
        F.col("product_photos_qty").cast("int").alias("photos_qty"),
        F.col("product_weight_g").cast("int").alias("weight_g"),
        *[F.col(f"product_{s}_cm").cast("int").alias(f"{s}_cm") for s in sides],
        volume.alias("volume_cm3"),
    )


def payments(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("order_id").isNotNull()).select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_seq"),
        F.trim(F.lower("payment_type")).alias("payment_type"),
        F.col("payment_installments").cast("int").alias("installments"),
        F.col("payment_value").cast("decimal(10,2)").alias("payment_value"),
    )


def reviews(raw: DataFrame) -> DataFrame:
    created = F.col("review_creation_date").cast("timestamp")
    answered = F.col("review_answer_timestamp").cast("timestamp")
    message = blank_to_null(F.col("review_comment_message"))
    return raw.where(F.col("review_id").isNotNull()).select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        blank_to_null(F.col("review_comment_title")).alias("comment_title"),
        message.alias("comment_message"),
        created.alias("created_at"),
        answered.alias("answered_at"),
        message.isNotNull().alias("has_comment"),
        hours_between(answered, created).alias("response_time_hours"),
    )
