"""Column names and table layouts shared by ingest, warehouse and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Header text (after strip + lower-case) -> canonical column name.
COLUMN_MAP = {
    "department": "department",
    "entity": "entity",
    "date of payment": "payment_date",
    "expense type": "expense_type",
    "expense area": "expense_area",
    "supplier": "supplier_name",
    "transaction number": "transaction_number",
    "amount": "amount",
    "description": "description",
    "supplier post code": "supplier_postcode",
    "supplier type": "supplier_type",
    "contract number": "contract_number",
    "project code": "project_code",
    "expenditure type": "expenditure_type",
}
CANONICAL_COLS = tuple(COLUMN_MAP.values())

# Rows whose core fields are all missing are blank or footer rows.
# The columns every source file has.
CORE_COLS = ("department", "supplier_name", "amount", "payment_date")

# Staging layout, in order.
STAGING_COLS = (
    "row_id", "department", "entity",
    "payment_date", "payment_year", "payment_month",
    "payment_month_name", "uk_fiscal_year", "uk_fiscal_quarter",
    "expense_type", "expense_area", "expenditure_type",
    "supplier_name", "supplier_name_clean",
    "supplier_postcode", "supplier_type",
    "transaction_number", "amount", "is_refund",
    "description", "contract_number", "project_code",
    "_source_file", "_load_timestamp",
)

# Load-order columns carried next to the staging layout: position of the row
# within its source file (after blank rows are dropped) and its key, unique and rising in load order;
# and what cleaning did to its cells, a sum of the bits below.
ORDER_COLS = ("_row_idx", "_row_key", "_flags")
UNPARSED_AMOUNT, UNPARSED_DATE, ROUNDED_AMOUNT = 1, 2, 4


def load_key(file_number: Column, position: Column, position_bits: int = 40) -> Column:
    """One number that orders rows by file, then position, which takes the lower ``position_bits``."""
    return F.shiftleft(file_number.cast("long"), position_bits) + position


# The stored tables, their columns in order and their types.
TABLE_SCHEMAS = {
    "dim_date": ("date_key int, full_date date, day int, month int, month_name string, quarter_name string, year int,"
                 " uk_fiscal_year string, uk_fiscal_quarter string, half_year string"),
    "dim_supplier": ("supplier_key bigint, supplier_name_raw string, supplier_name_clean string, supplier_postcode string,"
                     " supplier_type string"),
    "dim_expense": "expense_key bigint, expense_type string, expense_area string, expenditure_type string",
    "dim_entity": "entity_key bigint, department string, entity_name string, entity_group string, entity_subgroup string",
    "fact_transactions": ("transaction_key bigint, row_id string, date_key int, supplier_key bigint, expense_key bigint,"
                          " entity_key bigint, transaction_number string, amount decimal(28,2), is_refund int,"
                          " description string, source_file string, load_timestamp timestamp, fiscal_start int"),
}


def table_schema(name: str) -> StructType:
    """The declared schema of a stored table."""
    return StructType.fromDDL(TABLE_SCHEMAS[name])
