"""Column and row-shaping functions; all of them narrow, none shuffles."""

from paymart.functions.calendar import business_day, business_day_trunc
from paymart.functions.columns import (
    conform_rate,
    conform_transaction,
    currency_label,
    select_transaction_columns,
    to_target_columns,
)
from paymart.functions.messages import (
    decode_envelope,
    decode_json,
    decode_payload,
    encode_envelope,
    encode_json,
    encode_messages,
    parse_messages,
)
from paymart.functions.money import (
    RATE_RULES,
    convert_amount,
    rate_coalesce_one,
    rate_positive_else_one,
    round_average,
    round_total,
    round_whole,
)

__all__ = [
    "RATE_RULES",
    "business_day",
    "business_day_trunc",
    "conform_rate",
    "conform_transaction",
    "convert_amount",
    "currency_label",
    "decode_envelope",
    "decode_json",
    "decode_payload",
    "encode_envelope",
    "encode_json",
    "encode_messages",
    "parse_messages",
    "rate_coalesce_one",
    "rate_positive_else_one",
    "round_average",
    "round_total",
    "round_whole",
    "select_transaction_columns",
    "to_target_columns",
]
