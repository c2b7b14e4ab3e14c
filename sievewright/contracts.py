"""Schema contracts, fixed rule values and the two rule profiles (sales, financials)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names and types of the two business schemas.
SALES = StructType([
    StructField("Order_ID", IntegerType()),
    StructField("Customer_Name", StringType()),
    StructField("Region", StringType()),
    StructField("Order_Date", DateType()),
    StructField("Product", StringType()),
    StructField("Quantity", IntegerType()),
    StructField("Unit_Price", IntegerType()),
    StructField("Total_Amount", IntegerType()),
    StructField("Payment_Method", StringType()),
])

FINANCIALS = StructType([
    StructField("Row ID", LongType()),
    StructField("Segment", StringType()),
    StructField("Country", StringType()),
    StructField("Product", StringType()),
    StructField("Discount Band", StringType()),
    StructField("Units Sold", DoubleType()),
    StructField("Manufacturing Price", DoubleType()),
    StructField("Sale Price", DoubleType()),
    StructField("Gross Sales", DoubleType()),
    StructField("Discounts", DoubleType()),
    StructField("Sales", DoubleType()),
    StructField("COGS", DoubleType()),
    StructField("Profit", DoubleType()),
    StructField("Date", DateType()),
    StructField("Month Number", LongType()),
    StructField("Month Name", StringType()),
    StructField("Year", LongType()),
])

# Type names used in configuration files and what they mean here.
TYPE_NAMES = MappingProxyType({
    "int64": LongType(),
    "float": DoubleType(),
    "float64": DoubleType(),
    "object": StringType(),
    "string(100)": StringType(),
    "datetime64[ns]": TimestampType(),
    "date": DateType(),
})

# Metadata columns that any financials quarantine table may carry.
DIRTY_METADATA = (
    "issue", "source_file", "project_name", "logged_at", "column_flagged", "bad_date_value",
    "null_columns", "negative_columns", "row_hash", "column_name", "value",
)

# Rule parameters.
VALID_REGIONS = ("West", "East", "South", "North", "Central")
STREAM_TYPO_DICTIONARY = MappingProxyType({
    "Region": ("North", "South", "East", "West"),
    "Payment_Method": ("Cash", "Card", "Online"),
})
CLEANING_NULL_TOKENS = ("", "null", "none", "nan")
CLEANING_NULL_TOKENS_EXACT = ("", "NULL", "null", "none", "NaN", "nan", "Nan")
REPORT_NULL_TOKENS = ("", "NULL", "null", "none", "NaN", "nan", "Nan", "NA", "N/A", "n/a", "na")
CURRENCY_SIGNS = "€£$¥₱₩₦₭₮₨₹₡₢₫₲₴₵₸₺₼₾₿"
REPLACEMENT_CHARACTER = "\ufffd"
INVISIBLE_CHARACTERS = MappingProxyType({
    "\ufeff": "BOM/zero-width no-break space",
    "\u200b": "zero-width space",
    "\u200c": "zero-width non-joiner",
    "\u200d": "zero-width joiner",
    "\u2060": "word joiner",
    "\u202e": "right-to-left override",
    "\u202a": "left-to-right embedding",
    "\u202b": "right-to-left embedding",
    "\u00a0": "non-breaking space",
})
SPECIAL_CHARACTERS = REPLACEMENT_CHARACTER + "".join(INVISIBLE_CHARACTERS)
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "none", "Nan",
)


@dataclass(frozen=True)
class Profile:
    """How one business schema is cleaned and judged.

    ``key`` is the column that identifies a record: one row per key is loaded, and keys already loaded are skipped.
    ``reject_by``: ``"id"`` drops every row that shares its id with a type- or char-dirty row,
    ``"row"`` drops the dirty rows only. ``reject_chars=False`` reports char-dirty rows and keeps them.
    ``nonpositive_before_nulls`` lets the number rule also see rows that leave as null rows.
    """

    name: str
    contract: StructType
    key: str
    project_name: str = "sales_etl"
    title_mode: str = "words"
    upper_ids: tuple[str, ...] = ()
    skip_clean: tuple[str, ...] = ()
    region_column: str | None = None
    customer_column: str | None = None
    regions: tuple[str, ...] = ()
    nonpositive_op: str = "<="
    nonpositive_before_nulls: bool = False
    date_check: str = "pattern"
    case_sensitive_tokens: bool = False
    reject_by: str = "id"
    reject_chars: bool = True
    skip_chars: tuple[str, ...] = ()
    typo_dictionary: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    flag_valid_typos: bool = False
    min_text_length: int = 3

    def __post_init__(self) -> None:
        if self.key not in self.contract.fieldNames():
            raise ValueError(f"the key {self.key!r} is no column of the contract of {self.name!r}")

    @property
    def columns(self) -> list[str]:
        return self.contract.fieldNames()

    def with_options(self, **changes) -> Profile:
        return replace(self, **changes)


SALES_BATCH = Profile(
    name="sales",
    contract=SALES,
    key="Order_ID",
    region_column="Region",
    customer_column="Customer_Name",
    regions=VALID_REGIONS,
)

SALES_STREAM = SALES_BATCH.with_options(
    upper_ids=("Order_ID",),
    skip_clean=("description",),
    reject_chars=False,
    nonpositive_before_nulls=True,
    typo_dictionary=STREAM_TYPO_DICTIONARY,
)

FINANCIALS_BATCH = Profile(
    name="financials",
    contract=FINANCIALS,
    key="Row ID",
    title_mode="letters",
    nonpositive_op="<",
    reject_by="row",
    skip_chars=("Email", "Website"),
)


def all_text(contract: StructType) -> StructType:
    """The same columns, every one of them text: the shape in which records arrive."""
    return StructType([StructField(f.name, StringType()) for f in contract.fields])


def contract_from_names(types: Mapping[str, str], metadata: tuple[str, ...] = ()) -> StructType:
    """Build a contract from ``column -> type name``; unknown type names mean text."""
    fields = [StructField(n, TYPE_NAMES.get(t, StringType())) for n, t in types.items()]
    extra = [
        StructField(m, TimestampType() if m == "logged_at" else StringType())
        for m in metadata if m not in types
    ]
    return StructType(fields + extra)
