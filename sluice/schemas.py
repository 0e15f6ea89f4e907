"""Schemas of feeds, tables and lookups, and the fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_records"
INSERTED_AT = "insertion_timestamp"
STRUCTURED_AT = "structured_insertion_timestamp"


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(required: str = "", **types: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], name != required) for name, kind in types.items()])


# Column names and types of the feeds, the lookups and the structured tables.
CUSTOMERS_FEED = _struct(
    customer_id="string",
    first_name="string",
    last_name="string",
    email="string",
    phone_number="string",
    signup_date="date",
    country_code="string",
    department_code="string",
    _corrupt_records="string",
)
ORDERS_FEED = _struct(
    order_id="string",
    customer_id="string",
    product_id="string",
    order_date="date",
    quantity="int",
    _corrupt_records="string",
)
PRODUCTS_FEED = _struct(
    product_id="string", product_name="string", category="string", price="double", _corrupt_records="string"
)

COUNTRY_LOOKUP = _struct(country_code="string", country_name="string")
DEPARTMENT_LOOKUP = _struct(department_code="string", department_name="string")


def raw_schema(feed_schema: T.StructType) -> T.StructType:
    """A feed as landed: its columns and the insertion stamp."""
    return T.StructType([*feed_schema.fields, T.StructField(INSERTED_AT, T.TimestampType())])


def quarantine_schema(feed_schema: T.StructType) -> T.StructType:
    """A feed's rejected rows: its columns, why and when."""
    extra = _struct(rejection_reason="string", rejection_detail="string", rejected_at="timestamp")
    return T.StructType([*feed_schema.fields, *extra.fields])


STRUCTURED_CUSTOMERS = _struct(
    required="customer_id",
    customer_id="string",
    first_name="string",
    last_name="string",
    email="string",
    phone_number="string",
    signup_date="date",
    country_code="string",
    department_code="string",
    is_valid_country="string",
    is_valid_department="string",
    structured_insertion_timestamp="timestamp",
)
STRUCTURED_ORDERS = _struct(
    required="order_id",
    order_id="string",
    customer_id="string",
    product_id="string",
    order_date="date",
    order_year="int",
    order_month="int",
    order_day="int",
    quantity="int",
    is_valid_quantity="string",
    structured_insertion_timestamp="timestamp",
)
STRUCTURED_PRODUCTS = _struct(
    required="product_id",
    product_id="string",
    product_name="string",
    product_name_cleaned="string",
    category="string",
    price="double",
    price_category="string",
    is_valid_price="string",
    structured_insertion_timestamp="timestamp",
)

# Category domain of the products feed.
CATEGORIES = ["Electronics", "Clothing", "Food", "Books"]

# The region that each country code reports to.
REGION_OF_COUNTRY = {
    "AE": "Middle East",
    "AR": "South America",
    "AU": "Oceania",
    "BE": "Europe",
    "BR": "South America",
    "CA": "North America",
    "CH": "Europe",
    "CN": "Asia",
    "DE": "Europe",
    "DK": "Europe",
    "EG": "Africa",
    "ES": "Europe",
    "FI": "Europe",
    "FR": "Europe",
    "GB": "Europe",
    "GR": "Europe",
    "IE": "Europe",
    "IL": "Asia",
    "IN": "Asia",
    "IT": "Europe",
    "JP": "Asia",
    "KR": "Asia",
    "MX": "North America",
    "MY": "Asia",
    "NL": "Europe",
    "NO": "Europe",
    "NZ": "Oceania",
    "PH": "Asia",
    "PL": "Europe",
    "PT": "Europe",
    "RU": "Eastern Europe",
    "SA": "Middle East",
    "SE": "Europe",
    "SG": "Asia",
    "TH": "Asia",
    "TR": "Europe",
    "US": "North America",
    "ZA": "Africa",
}
