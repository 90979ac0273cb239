"""Declared shape of the nine source tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
MONEY = T.DecimalType(12, 2)
TIME = T.TimestampNTZType()
FLOAT = T.DoubleType()


@dataclass(frozen=True)
class SourceTable:
    """One raw table: its file pattern, typed columns, load mode and published size."""

    name: str
    file: str
    schema: T.StructType
    strategy: Literal["merge", "full_refresh"]
    primary_key: tuple[str, ...] = ()
    expected_rows: int | None = None
    never_sample: bool = False

    def __post_init__(self) -> None:
        if self.strategy == "merge" and not self.primary_key:
            raise ValueError(f"{self.name}: a merge load needs a primary key")

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        """The columns as stored: declared ones plus lineage."""
        return (
            T.StructType(list(self.schema.fields))
            .add("_source_file", TEXT)
            .add("_loaded_at", T.TimestampType())
        )


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Names, types, keys and published row counts of the source extract.
SOURCE_TABLES: tuple[SourceTable, ...] = (
    SourceTable(
        "customers",
        "*customers_dataset.csv",
        _schema(
            customer_id=TEXT,
            customer_unique_id=TEXT,
            customer_zip_code_prefix=TEXT,
            customer_city=TEXT,
            customer_state=TEXT,
        ),
        "merge",
        ("customer_id",),
        99_441,
    ),
    SourceTable(
        "geolocation",
        "*geolocation_dataset.csv",
        _schema(
            geolocation_zip_code_prefix=TEXT,
            geolocation_lat=FLOAT,
            geolocation_lng=FLOAT,
            geolocation_city=TEXT,
            geolocation_state=TEXT,
        ),
        "full_refresh",
        expected_rows=1_000_163,
    ),
    SourceTable(
        "order_items",
        "*order_items_dataset.csv",
        _schema(
            order_id=TEXT,
            order_item_id=INT,
            product_id=TEXT,
            seller_id=TEXT,
            shipping_limit_date=TIME,
            price=MONEY,
            freight_value=MONEY,
        ),
        "merge",
        ("order_id", "order_item_id"),
        112_650,
    ),
    SourceTable(
        "order_payments",
        "*order_payments_dataset.csv",
        _schema(
            order_id=TEXT,
            payment_sequential=INT,
            payment_type=TEXT,
            payment_installments=INT,
            payment_value=MONEY,
        ),
        "merge",
        ("order_id", "payment_sequential"),
        103_886,
    ),
    SourceTable(
        "order_reviews",
        "*order_reviews_dataset.csv",
        _schema(
            review_id=TEXT,
            order_id=TEXT,
            review_score=INT,
            review_comment_title=TEXT,
            review_comment_message=TEXT,
            review_creation_date=TIME,
            review_answer_timestamp=TIME,
        ),
        "full_refresh",
        expected_rows=99_224,
    ),
    SourceTable(
        "orders",
        "*orders_dataset.csv",
        _schema(
            order_id=TEXT,
            customer_id=TEXT,
            order_status=TEXT,
            order_purchase_timestamp=TIME,
            order_approved_at=TIME,
            order_delivered_carrier_date=TIME,
            order_delivered_customer_date=TIME,
            order_estimated_delivery_date=TIME,
        ),
        "merge",
        ("order_id",),
        99_441,
    ),
    SourceTable(
        "products",
        "*products_dataset.csv",
        _schema(
            product_id=TEXT,
            product_category_name=TEXT,
            product_name_lenght=INT,
            product_description_lenght=INT,
            product_photos_qty=INT,
            product_weight_g=INT,
            product_length_cm=INT,
            product_height_cm=INT,
            product_width_cm=INT,
        ),
        "merge",
        ("product_id",),
        32_951,
    ),
    SourceTable(
        "sellers",
        "*sellers_dataset.csv",
        _schema(seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT),
        "merge",
        ("seller_id",),
        3_095,
    ),
    SourceTable(
        "product_category_translation",
        "product_category_name_translation.csv",
        _schema(product_category_name=TEXT, product_category_name_english=TEXT),
        "merge",
        ("product_category_name",),
        71,
        never_sample=True,
    ),
)

BY_NAME = {table.name: table for table in SOURCE_TABLES}


def source_table(name: str) -> SourceTable:
    if name not in BY_NAME:
        raise KeyError(f"Unknown table '{name}'. Known tables: {', '.join(sorted(BY_NAME))}")
    return BY_NAME[name]
