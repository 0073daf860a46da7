"""Run parameters. Nothing in the library reads the wall clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

# Fixed values of the business rules.
FPOINT = "fpoint"
FREESHIP = "freeship"
VIP_LEVEL = "vip level"
ACTION_ACCRUE = "accure fpoint"
ACTION_FREESHIP = "add more freeship"
ACTION_UPGRADE = "upgrade level"
ACTION_REFER = "add refer fpoint"
ACTION_ORDER_COUNT = "x order get y reward"
ATTR_NOT_CONFIRMED = 16
ATTR_COMPANY = 178

# Names of campaign actions, campaign filters and review rule types.
CHEAPEST = "cheapest"
HIGHEST = "highest"
PROMO_FPOINT = "promo_fpoint"
PROMO_FREESHIP = "promo_freeship"
FILTER_GRAND_TOTAL = "grand_total"
FILTER_NUM_ITEM = "num_item"
ITEM_FILTERS = ("sku", "category_main_id", "category_mid_id")
REVIEW_CHARACTER = "character"
REVIEW_LIKE = "like"


@dataclass(frozen=True)
class Params:
    """`as_of` is the run instant in shop-local time; stored timestamps are UTC."""

    as_of: datetime
    tz_offset_hours: int = 7
    accrual_days: int = 30
    order_count_days: int = 60
    referral_days: int = 45
    # Likes may arrive so late and are counted still.
    like_lag_hours: int = 24
    # Fixed values of the business rules.
    excluded_products: tuple[int, ...] = (72984, 72985, 167338)
    excluded_skus: tuple[str, ...] = (
        "1903041244305a",
        "1903041244312a",
        "codedientu100000",
        "phieuquatang60000",
    )
    excluded_mid_categories: tuple[str, ...] = ("4388", "5421", "6152")
    freeship_step: int = 10_000
    campaign_max: int = 10_000_000
    review_max: int = 10_000
    review_char_buffer: int = 20
    new_customer_from: datetime = datetime(2018, 10, 22, 0, 0, 1)
    upgrade_floor: int = 30_000
    warm_up_orders: int = 3
    updated_by: str = "reward job"

    def since_midnight(self, days: int) -> datetime:
        """Start of a look-back counted from the midnight before the run."""
        midnight = self.as_of.replace(hour=0, minute=0, second=0, microsecond=0)
        return midnight - timedelta(days=days)

    def since_hours(self, hours: int) -> datetime:
        return self.as_of - timedelta(hours=hours)

    def since_instant(self, days: int) -> datetime:
        """Start of a look-back counted from the run instant."""
        return self.as_of - timedelta(days=days)
