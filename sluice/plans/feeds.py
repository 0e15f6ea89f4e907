"""The three feeds as values: schema, rules, key, and how clean rows are shaped."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice import schemas
from sluice.functions import flags, transforms
from sluice.operators.quality import Rule

# Names of flags and messages of rules, here and in the rules below.
REQUIRED = "has_null_required"
REQUIRED_MESSAGE = "Required field is null"


@dataclass(frozen=True)
class Feed:
    """Everything that sets one feed apart from another."""

    name: str
    schema: StructType
    key: str
    required: list[str]
    rules: Callable[[], list[Rule]]
    structured: Callable[[], list[Column]]
    partition_by: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        """Columns of the feed itself, without the corrupt-record column."""
        return [name for name in self.schema.fieldNames() if name != schemas.CORRUPT]

    def all_rules(self) -> list[Rule]:
        required = Rule(REQUIRED, flags.any_null(self.required), bad_value="Y", message=REQUIRED_MESSAGE)
        return [required, *self.rules()]


def _customer_rules() -> list[Rule]:
    return [
        Rule("is_valid_email", flags.email_format("email"), message="Invalid email format"),
        Rule("is_valid_country", hard=False, lookup="country_code", column="country_code"),
        Rule("is_valid_department", hard=False, lookup="department_code", column="department_code"),
    ]


def _customer_columns(salt: str = "") -> list[Column]:
    hashed = ["first_name", "last_name", "email", "phone_number"]
    codes = ["country_code", "department_code"]
    return [
        F.col("customer_id"),
        *[transforms.hash_pii(name, salt).alias(name) for name in hashed],
        F.col("signup_date"),
        *[transforms.normalize_code(name).alias(name) for name in codes],
        F.col("is_valid_country"),
        F.col("is_valid_department"),
    ]


def _order_rules() -> list[Rule]:
    return [
        Rule("is_valid_quantity", flags.positive("quantity"), message="Invalid quantity (zero or negative)"),
        Rule("is_valid_date", flags.date_between("order_date", min_date="2020-01-01"), message="Invalid order date"),
    ]


def _order_columns() -> list[Column]:
    return [
        *[F.col(name) for name in ("order_id", "customer_id", "product_id", "order_date")],
        *transforms.date_parts("order_date"),
        F.col("quantity"),
        F.col("is_valid_quantity"),
    ]


def _product_rules() -> list[Rule]:
    return [
        Rule("is_valid_price", flags.positive("price"), message="Invalid price (zero, negative, or non-numeric)"),
        Rule("is_valid_category", flags.in_domain("category", schemas.CATEGORIES), hard=False),
    ]


def _product_columns() -> list[Column]:
    return [
        F.col("product_id"),
        F.trim("product_name").alias("product_name"),
        transforms.clean_name("product_name").alias("product_name_cleaned"),
        F.trim("category").alias("category"),
        F.col("price"),
        transforms.price_band("price").alias("price_category"),
        F.col("is_valid_price"),
    ]


CUSTOMERS = Feed(
    "customers", schemas.CUSTOMERS_FEED, "customer_id", ["customer_id", "email"], _customer_rules, _customer_columns
)
ORDERS = Feed(
    "orders",
    schemas.ORDERS_FEED,
    "order_id",
    ["order_id", "customer_id", "product_id", "order_date"],
    _order_rules,
    _order_columns,
    partition_by=["order_year"],
)
PRODUCTS = Feed(
    "products",
    schemas.PRODUCTS_FEED,
    "product_id",
    ["product_id", "product_name", "category"],
    _product_rules,
    _product_columns,
)
FEEDS = {feed.name: feed for feed in (CUSTOMERS, ORDERS, PRODUCTS)}


def salted_customers(salt: str) -> Feed:
    """The customers feed with a salt in front of every hashed value."""
    return Feed(
        CUSTOMERS.name,
        CUSTOMERS.schema,
        CUSTOMERS.key,
        CUSTOMERS.required,
        CUSTOMERS.rules,
        lambda: _customer_columns(salt),
    )
