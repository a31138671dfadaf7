"""Column functions (built-in Spark expressions, and one Arrow step for unusual literals)."""
from starforge.functions.text import (  # noqa: F401
    city_of, excel_line, lenient_number, lenient_timestamp, money_text, percent_text, plain_groups, plain_list, py_strip,
    quote_field, ratio_round, strict_true, unwrap_excel, with_literals,
)
