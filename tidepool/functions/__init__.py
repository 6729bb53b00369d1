"""Column expressions (pure, JVM-side, codegen-friendly)."""

from tidepool.functions.casts import soft_bigint, soft_double, text_array, text_date
from tidepool.functions.codes import check_digit, with_check_digit, zero_pad
from tidepool.functions.jsonx import as_json_list, json_text, polymorphic_code, polymorphic_text
from tidepool.functions.text import (
    classify_keywords,
    human_size,
    json_string_list,
    path_key,
    sql_bool,
    sql_json,
    sql_value,
    underscore_words,
)

__all__ = [
    "as_json_list",
    "check_digit",
    "classify_keywords",
    "human_size",
    "json_string_list",
    "json_text",
    "path_key",
    "polymorphic_code",
    "polymorphic_text",
    "soft_bigint",
    "soft_double",
    "sql_bool",
    "sql_json",
    "sql_value",
    "text_array",
    "text_date",
    "underscore_words",
    "with_check_digit",
    "zero_pad",
]
