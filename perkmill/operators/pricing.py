"""Bundle prices and suborder amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bounds import between_ids

BUNDLE_KEY = ["suborder_id", "bundle_id", "bundle_type"]
SUBORDER_KEY = ["order_id", "suborder_id"]
# Narrow enough that price times quantity stays exact within 38 digits.
_PRICE, _QTY = "decimal(22,8)", "decimal(15,0)"


def bundle_price(item: DataFrame, bundle: DataFrame) -> DataFrame:
    """Item rows with the price and quantity that count once a bundle row applies. Items are read once;
    those without a bundle meet none, and are spread over the join's tasks by their suborder."""
    terms = bundle.select(*BUNDLE_KEY, "saving", F.col("qty").alias("bundle_qty"), F.lit(True).alias("bundled"))
    in_bundle = F.col("bundled").isNotNull()
    kept = (1 - F.col("saving").cast("decimal(8,4)")) * F.col("price").cast("decimal(18,4)")
    price = F.when(in_bundle, kept).otherwise(F.col("price"))
    qty = F.when(in_bundle, F.col("bundle_qty").cast("long") * F.col("qty")).otherwise(F.col("qty"))
    joined = item.join(terms, BUNDLE_KEY, "left")
    return joined.select(*item.columns, price.cast(_PRICE).alias("eff_price"), qty.cast("long").alias("eff_qty"))


def countable_items(item: DataFrame, excluded_products: tuple[int, ...]) -> DataFrame:
    """Items that may earn points; an unknown product does not."""
    return item.filter(~F.col("product_id").isin(*excluded_products))


def items_of(item: DataFrame, wanted: DataFrame) -> DataFrame:
    """Items of the wanted suborders. They are looked up before anything folds or shuffles them: the
    items of a look-back are few among those of all time. Hand over `wanted` written out, since it is
    read for its bounds too; it holds a suborder about once, so its keys go to the look-up as they are."""
    return between_ids(item, "order_id", wanted).join(wanted.select(*SUBORDER_KEY), SUBORDER_KEY, "left_semi")


def bundles_of(bundle: DataFrame, wanted: DataFrame) -> DataFrame:
    return between_ids(bundle, "suborder_id", wanted).join(wanted.select("suborder_id"), "suborder_id", "left_semi")


def goods_value(item: DataFrame, bundle: DataFrame) -> DataFrame:
    """Sum of effective price times effective quantity per suborder; sums start on the map side."""
    value = F.col("eff_price") * F.col("eff_qty").cast(_QTY)
    return bundle_price(item, bundle).groupBy(*SUBORDER_KEY).agg(F.sum(value).alias("goods"))


def _fee(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def suborder_amount(eligible: DataFrame, item: DataFrame, bundle: DataFrame) -> DataFrame:
    """Goods plus fees minus discounts, floored; null when no item has a price.

    `item` holds countable items only; a suborder without any drops out. Hand over `eligible` written
    out.
    """
    total = (
        F.col("goods")
        + _fee("cod_fee")
        + _fee("shipping_fee")
        - _fee("discount_amount")
        + _fee("giftwrap_fee")
        - _fee("tryout_discount")
    )
    return (
        eligible.join(goods_value(items_of(item, eligible), bundles_of(bundle, eligible)), SUBORDER_KEY)
        .withColumn("amount", F.floor(total.cast("double")).cast("double"))
        .drop("goods", "cod_fee", "shipping_fee", "discount_amount", "giftwrap_fee", "tryout_discount")
    )


def order_products(item: DataFrame, bundle: DataFrame) -> DataFrame:
    """Per suborder and product: quantity and price extremes after bundle terms."""
    return bundle_price(item, bundle).groupBy(*SUBORDER_KEY, "product_id").agg(
        F.sum("eff_qty").alias("qty"), F.min("eff_price").alias("min_price"), F.max("eff_price").alias("max_price")
    )
