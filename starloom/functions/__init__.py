"""Scalar column expressions (built-in Spark functions only)."""

from starloom.functions.recode import (  # noqa: F401
    case_else_label, case_label, decode_flag, decode_status, encode_flag,
    encode_status, in_domain, lookup, not_in_domain, parse_number, recode_binary,
    recode_binary_lenient, recode_sex, recode_target, scale_bmi, size_mb,
)
