"""Declared table schemas.

Fixed values: column names of the tables with an explicit schema, in table order.
"""

from __future__ import annotations

from pyspark.sql import types as T

_NUMBER = T.DoubleType()
_TEXT = T.StringType()


def text_and_double(text: str, doubles: str = "") -> T.StructType:
    """A flat schema; names listed in ``doubles`` are DOUBLE, the rest STRING."""
    numbers = set(doubles.split())
    return T.StructType([T.StructField(c, _NUMBER if c in numbers else _TEXT) for c in text.split()])


CALENDAR = text_and_double("busi_date market_no trade_flag")
UNITS = text_and_double(
    "departmentid shortname fullname subcompanyid supdepartmentid showorder code canceled "
    "create_time update_user update_time business_line_id business_line_name "
    "respons_line_id respons_line_name")
BUSINESS_LINES = text_and_double(
    "pk_id business_line_id business_line_name update_user update_time if_use")
RESPONS_LINES = text_and_double(
    "pk_id respons_line_id respons_line_name update_user update_time if_use "
    "up_respons_line_id up_respons_line_name")
TARGET_TYPES = text_and_double("busi_type busi_type_name is_select_flag")
QUARTER_TARGETS = text_and_double(
    "oa_branch_id busi_type busi_type_name complete_value complete_value_rate busi_year busi_quarter",
    doubles="complete_value complete_value_rate")
LEDGER_ACTIVITY = text_and_double("book_id index_value", doubles="index_value")

# Type names accepted in schema text; anything unknown, and datetime, is read as text.
TYPE_NAMES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "double": T.DoubleType(), "float": T.FloatType(), "byte": T.ByteType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(),
    "datetime": T.StringType(),
}


def schema_of(columns: dict[str, str]) -> T.StructType:
    """``{name: type name}`` as a schema."""
    return T.StructType([T.StructField(n, TYPE_NAMES.get(t.lower(), _TEXT)) for n, t in columns.items()])
