"""Column builders. Each takes and returns a Column, stays inside code generation and never raises on bad text."""

from estrato.functions.dates import (  # noqa: F401
    CALENDAR_END,
    CALENDAR_START,
    MISSING_DATE_SK,
    MONTH_NAMES,
    OUTSIDE_DATE_SK,
    calendar_columns,
    date_sk,
    parse_control_timestamp,
    parse_date_br,
)
from estrato.functions.keys import concat_key, hash_key, sha256_in_path  # noqa: F401
from estrato.functions.numbers import (  # noqa: F401
    exact_sum,
    money_as_written,
    money_from_text,
    parse_decimal_br,
    percent,
    share,
)
from estrato.functions.text import (  # noqa: F401
    blank_to_null,
    clean_text,
    clean_upper,
    dash_to_null,
    is_blank_only,
    is_safe_id,
    json_list,
    normalize_location,
    parse_yes_no,
)
