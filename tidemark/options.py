"""Tunable parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the event format: parameter key -> column.
ITEM_PARAMS = {
    "discountt": "discount_value",
    "totalPrice": "total_price",
    "number_of_installments": "installments",
    "installment_price": "installment_price",
    "discounts": "discounts",
    "in_stock": "is_in_stock",
}

# Fixed values of the event format: backfill column -> key in the item string.
BACKFILL_FIELDS = {
    "product_category_1": "item_category",
    "product_category_2": "item_category2",
    "product_category_3": "item_category3",
    "product_category_4": "item_category4",
    "product_category_5": "item_category5",
    "promotion_id": "promotion_id",
    "promotion_name": "promotion_name",
    "creative_name": "creative_name",
    "creative_slot": "creative_slot",
    "coupon": "coupon",
    "affiliation": "affiliation",
}

DEFAULT_BACKFILL = tuple(c for c in BACKFILL_FIELDS if c.startswith("product_category"))

PLATFORMS = ((1, "IOS"), (2, "ANDROID"))


@dataclass(frozen=True)
class Options:
    session_minutes: int = 30
    high_value_threshold: float = 500
    # What a cart line is worth: "price" in the shop's currency, or "price_in_usd".
    cart_value_column: str = "price"
    required_fields: tuple = ("event_id", "event_name", "event_timestamp")
    item_params: dict = field(default_factory=lambda: dict(ITEM_PARAMS))
    # Codes containing this text are experiment variants, all others are campaigns.
    experiment_pattern: str = "XP_"
    message_ttl: str = "14 days"
    platforms: tuple = PLATFORMS
