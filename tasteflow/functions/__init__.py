"""Column expressions used by the operators (all JVM-side, codegen friendly)."""

from tasteflow.functions.lists import format_recs, lists_to_ranked, ranked_to_lists, rec_struct
from tasteflow.functions.text import (
    field,
    jvm_double,
    jvm_trim,
    payload_after,
    split_literal,
    strict_int,
    strict_long,
)
from tasteflow.functions.time import epoch_day, epoch_seconds, year_month

__all__ = [
    "epoch_day", "epoch_seconds", "field", "format_recs", "jvm_double", "jvm_trim",
    "lists_to_ranked", "payload_after", "ranked_to_lists", "rec_struct",
    "split_literal", "strict_int", "strict_long", "year_month",
]
