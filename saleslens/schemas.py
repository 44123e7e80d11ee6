"""Table schemas of the retail star (Sales fact; Products, Customers, Calendar).

Money is DECIMAL, text is UTF-8 STRING, flags are BOOLEAN. ``TABLE_RULES`` carries the
constraints a row store would enforce on insert (key, not-null, text length, decimal
range); Parquet enforces none of them, so ``operators.quality`` checks them explicitly.
"""

from pyspark.sql import types as T

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("brand", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("calories_per_100g", T.DecimalType(8, 2), True),
    T.StructField("is_organic", T.BooleanType(), True),
    T.StructField("unit_price", T.DecimalType(10, 2), False),
    T.StructField("launch_date", T.DateType(), True),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("customer_type", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("registration_date", T.DateType(), True),
    T.StructField("is_active", T.BooleanType(), True),
])

SALES = T.StructType([
    T.StructField("sale_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("sale_date", T.DateType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(10, 2), False),
    T.StructField("discount_pct", T.DecimalType(5, 2), True),
    T.StructField("discount_amount", T.DecimalType(10, 2), True),
    T.StructField("total_amount", T.DecimalType(10, 2), False),
])

CALENDAR = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
])

SCHEMAS = {"products": PRODUCTS, "customers": CUSTOMERS, "sales": SALES, "calendar": CALENDAR}

# The declared table constraints of the star schema.
TABLE_RULES = {
    "products": {
        "key": ["product_id"],
        "not_null": ["product_id", "product_name", "unit_price"],
        "max_length": {"product_name": 300, "brand": 150, "category": 100},
        "decimal": {"calories_per_100g": (8, 2), "unit_price": (10, 2)},
        "defaults": {"is_organic": False},
    },
    "customers": {
        "key": ["customer_id"],
        "not_null": ["customer_id", "customer_name"],
        "max_length": {"customer_name": 200, "customer_type": 50, "region": 100, "country": 100},
        "decimal": {},
        "defaults": {"is_active": True},
    },
    "sales": {
        "key": ["sale_id"],
        "not_null": ["sale_id", "product_id", "customer_id", "sale_date", "quantity",
                     "unit_price", "total_amount"],
        "max_length": {},
        "decimal": {"unit_price": (10, 2), "discount_pct": (5, 2), "discount_amount": (10, 2),
                    "total_amount": (10, 2)},
        "defaults": {"discount_pct": 0, "discount_amount": 0},
        "foreign_keys": {"product_id": ("products", "product_id"),
                         "customer_id": ("customers", "customer_id"),
                         "sale_date": ("calendar", "full_date")},
    },
    "calendar": {
        "key": ["date_key"],
        "not_null": ["date_key", "full_date", "year", "quarter", "month", "month_name", "week",
                     "day_of_week"],
        "max_length": {"month_name": 20},
        "decimal": {},
        "defaults": {},
    },
}
