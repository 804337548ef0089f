"""Source-file contracts: columns, types, fingerprint fields.

A contract is what a loader promises about a source file: which columns it
keeps (a whitelist), how each is typed, and which fields make up the row
fingerprint.  The fingerprint field lists default to the ones the reference's
loaders hash; they are parameters, so a caller can add the business columns
those loaders leave out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Text tokens read as missing (the pandas CSV reader's default NA list, which
# the reference's loaders rely on).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[tuple[str, str], ...]
    # (column, kind) with kind "ts" for timestamps, "text" otherwise
    hash_fields: tuple[tuple[str, str], ...] = field(default_factory=tuple)
    keys: tuple[str, ...] = field(default_factory=tuple)
    multiline: bool = False  # quoted texts may hold line breaks

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def timestamp_columns(self) -> list[str]:
        return [c for c, t in self.columns if t == "timestamp_ntz"]


ORDERS = Contract(
    table="orders_raw",
    columns=(("order_id", "string"), ("customer_id", "string"), ("order_status", "string"),
             ("order_approved_at", "timestamp_ntz"),
             ("order_delivered_customer_date", "timestamp_ntz"),
             ("order_estimated_delivery_date", "timestamp_ntz")),
    hash_fields=(("order_id", "text"), ("customer_id", "text"), ("order_status", "text"),
                 ("order_approved_at", "ts"), ("order_delivered_customer_date", "ts"),
                 ("order_estimated_delivery_date", "ts")),
    keys=("order_id",),
)

ORDER_ITEMS = Contract(
    table="order_items_raw",
    columns=(("order_id", "string"), ("order_item_id", "int"), ("product_id", "string"),
             ("seller_id", "string"), ("price", "decimal(12,2)"),
             ("freight_value", "decimal(12,2)")),
    hash_fields=(("order_id", "text"), ("order_item_id", "text"), ("product_id", "text"),
                 ("seller_id", "text")),
    keys=("order_id", "order_item_id"),
)

CUSTOMERS = Contract(
    table="customers_raw",
    columns=(("customer_id", "string"), ("customer_city", "string"),
             ("customer_state", "string")),
    hash_fields=(("customer_id", "text"), ("customer_city", "text"),
                 ("customer_state", "text")),
    keys=("customer_id",),
)

PRODUCTS = Contract(
    table="products_raw",
    columns=(("product_id", "string"), ("product_category_name", "string")),
    hash_fields=(("product_id", "text"), ("product_category_name_english", "text")),
    keys=("product_id",),
)

CATEGORY_TRANSLATION = Contract(
    table="category_translation",
    columns=(("product_category_name", "string"),
             ("product_category_name_english", "string")),
    keys=("product_category_name",),
)

REVIEWS = Contract(
    table="reviews_raw",
    columns=(("review_id", "string"), ("order_id", "string"), ("review_score", "int"),
             ("review_creation_date", "timestamp_ntz")),
    hash_fields=(("review_id", "text"), ("order_id", "text"),
                 ("review_creation_date", "ts")),
    keys=("review_id",), multiline=True,
)

SELLERS = Contract(
    table="sellers_raw",
    columns=(("seller_id", "string"), ("seller_city", "string"), ("seller_state", "string")),
    hash_fields=(("seller_id", "text"), ("seller_city", "text"), ("seller_state", "text")),
    keys=("seller_id",),
)

HOLIDAYS = Contract(
    table="holidays_raw",
    columns=(("date", "date"), ("holiday_name", "string"), ("city", "string"),
             ("state", "string"), ("scope", "string")),
)

CONTRACTS = {c.table: c for c in (ORDERS, ORDER_ITEMS, CUSTOMERS, PRODUCTS,
                                  CATEGORY_TRANSLATION, REVIEWS, SELLERS, HOLIDAYS)}
