"""Column-level helpers: every function takes and returns ``Column`` objects and is
built from native Spark expressions only (codegen-friendly, no Python per row)."""

from casebook.functions.columns import as_column, as_list
from casebook.functions.text import (null_tokens, leading_number, parse_measure,
                                     parse_timestamp, concat_nullsafe, percent_text)
from casebook.functions.lists import split_list, list_size
from casebook.functions.dates import (minutes_between, days_between, month_key,
                                      iso_weekday, week_of_year_block)
from casebook.functions.safe import safe_div, pct

__all__ = [
    "as_column", "as_list",
    "null_tokens", "leading_number", "parse_measure", "parse_timestamp", "concat_nullsafe",
    "percent_text", "split_list", "list_size", "minutes_between", "days_between",
    "month_key", "iso_weekday", "week_of_year_block", "safe_div", "pct",
]
