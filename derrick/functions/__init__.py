"""Column functions shared by the operators."""

from derrick.functions.dates import (
    add_hours,
    date_parts,
    days_until,
    micros,
    parse_timestamp,
    to_day,
)
from derrick.functions.hashing import fraction_hash, split_hash
from derrick.functions.numeric import (
    absent,
    band,
    clamp,
    in_range_or_false,
    measure,
    per_unit,
    round_exact,
    round_half_even,
    round_half_up,
    row_max_abs,
    valid,
)

__all__ = [
    "absent",
    "add_hours",
    "band",
    "clamp",
    "date_parts",
    "days_until",
    "fraction_hash",
    "in_range_or_false",
    "measure",
    "micros",
    "parse_timestamp",
    "per_unit",
    "round_exact",
    "round_half_even",
    "round_half_up",
    "row_max_abs",
    "split_hash",
    "to_day",
    "valid",
]
