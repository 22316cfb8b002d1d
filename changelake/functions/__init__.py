from changelake.functions.cleaners import clean_code, clean_date, clean_number, clean_whitespace
from changelake.functions.keys import (
    normalize_database,
    normalize_table_name,
    record_id,
    row_id,
    stringify,
)

__all__ = [
    "clean_code",
    "clean_date",
    "clean_number",
    "clean_whitespace",
    "normalize_database",
    "normalize_table_name",
    "record_id",
    "row_id",
    "stringify",
]
