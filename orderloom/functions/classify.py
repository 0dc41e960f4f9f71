"""Business classification of events, cycles and item weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import blank_to_null, col, kv_value

# Code families, application codes and names of the event taxonomy.
SALES_APPS = ("PDA-A", "CatalogFS-I", "CatalogFS-A")
EXCLUDED_SALES_CODE = "000"
ADD_FAMILY, REMOVE_FAMILY, QTY_FAMILY = "1005", "1004", "1015"
ORDER_FAMILY = "04"
CUSTOMER_APP_SUBMIT = "04050100"
SUBMIT_PAYLOAD = "%increment_id:%"
FEATURES = (
    "catalog_view",
    "filter",
    "icon_click",
    "image_enlarge",
    "item_detail",
    "oos_check",
    "search",
)
FAMILY_FEATURE = {
    "11": "filter",
    "12": "search",
    "14": "item_detail",
    "15": "image_enlarge",
    "19": "catalog_view",
}
PAGE_CONTEXTS = ("backorder", "history", "suggest", "promo")
FRICTION_FAMILIES = {
    "request_review": "05",
    "sales_review": "06",
    "restore_order": "07",
    "delete_order": "08",
}


def first_match(*pairs: tuple[Column, str]) -> Column:
    """The label of the first true condition, NULL when none is true."""
    (condition, label), *rest = pairs
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out


def is_sales_app(source: Column | str) -> Column:
    return col(source).isin(*SALES_APPS)


def actor_type(source: Column | str) -> Column:
    return F.when(is_sales_app(source), "sales").otherwise("customer")


def customer_key(source: str, customer_no: str, username: str, payload: str) -> Column:
    """Whom the event is about: a rep names the customer, a customer is the login itself."""
    named = F.coalesce(blank_to_null(customer_no), kv_value(payload, "ust_customer_no"))
    return F.when(is_sales_app(source), named).otherwise(blank_to_null(username))


def event_flags(code: str, family: str, name: str, mapped: Column) -> dict[str, Column]:
    """Dictionary-driven columns. Unmapped codes get NULL labels and false flags."""
    title = F.lower(col(name))
    action = F.substring(col(code), 1, 4)
    l1 = col(family)
    stock_check = title.contains("oos")
    icon_tap = (l1 == "18") & title.contains("icon")

    def labelled(*pairs: tuple[Column, str]) -> Column:
        return F.when(mapped, first_match(*pairs))

    return {
        "outcome": labelled(
            (title.contains("fail"), "fail"),
            (title.contains("success"), "success"),
        ),
        "is_add": mapped & (action == ADD_FAMILY),
        "is_remove": mapped & (action == REMOVE_FAMILY),
        "is_qty_change": mapped & (action == QTY_FAMILY),
        "feature_name": labelled(
            (stock_check, "oos_check"),
            *((l1 == code, feature) for code, feature in FAMILY_FEATURE.items()),
            (icon_tap, "icon_click"),
        ),
        "page_context": labelled(*((title.contains(word), word) for word in PAGE_CONTEXTS)),
        "feature_group": labelled(
            (action.isin(ADD_FAMILY, REMOVE_FAMILY, QTY_FAMILY), "cart"),
            (stock_check, "stock"),
            (l1.isin("11", "12", "19") | icon_tap, "discovery"),
            (l1.isin("14", "15"), "navigation"),
        ),
    }


def is_cart_edit() -> Column:
    return F.col("is_add") | F.col("is_remove") | F.col("is_qty_change")


def has_order_payload() -> Column:
    # LIKE on purpose: "_" stands for any character here.
    return (F.col("l1_code") == ORDER_FAMILY) & F.col("response").like(SUBMIT_PAYLOAD)


def is_submit() -> Column:
    bare = (F.col("l1_code") == ORDER_FAMILY) & (F.col("description_code") == CUSTOMER_APP_SUBMIT)
    return F.coalesce(has_order_payload(), F.lit(False)) | F.coalesce(bare, F.lit(False))


def cycle_status(submitted: Column, idle_days: Column, abandon_days: int) -> Column:
    return (
        F.when(submitted, "submitted")
        .when(idle_days >= abandon_days, "abandoned")
        .otherwise("open")
    )


def cycle_segment(
    adds: Column, removes: Column, submitted: Column, features: Column, minutes: Column
) -> Column:
    return (
        F.when(removes > adds, "churner")
        .when(submitted & (features <= 1) & (minutes <= 15), "quick_reorder")
        .when(features >= 3, "browser")
        .otherwise("mixed")
    )


def service_mode(own: Column, total: Column) -> Column:
    # Shares of 80% and 20% in whole numbers, so that no share is lost to rounding.
    return (
        F.when(own * 5 >= total * 4, "self_service")
        .when(own * 5 <= total, "sales_assisted")
        .otherwise("mixed")
    )


def days_bucket(days: Column) -> Column:
    """NULL and negative spans fall into the last bucket."""
    return (
        F.when(days == 0, "same-day")
        .when(days.between(1, 3), "1-3d")
        .when(days.between(4, 7), "4-7d")
        .when(days.between(8, 14), "8-14d")
        .otherwise("14d+")
    )


def journey_segment(churn_ratio: Column, days: Column) -> Column:
    return (
        F.when(churn_ratio >= 0.3, "High Editor")
        .when((churn_ratio < 0.1) & (days <= 1), "Decisive")
        .when(days >= 4, "Planner")
        .otherwise("Slow Sender")
    )
