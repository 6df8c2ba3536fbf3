"""Column-level helpers: every function here returns a ``Column`` built from
Spark's own expressions, so it stays inside whole-stage codegen."""

from layertables.functions.hashing import NULL_MARK, content_key
from layertables.functions.predicates import all_null, any_null, same_values
from layertables.functions.time import OPEN_END, open_end, parse_time, time_type_of

__all__ = [
    "NULL_MARK",
    "OPEN_END",
    "all_null",
    "any_null",
    "content_key",
    "open_end",
    "parse_time",
    "same_values",
    "time_type_of",
]
