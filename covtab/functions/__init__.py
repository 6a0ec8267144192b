"""Column expressions. All are built from ``pyspark.sql.functions`` so they
run inside whole-stage codegen on the executors; none is a Python UDF."""

from covtab.functions.predicates import known_code, valid_asof
from covtab.functions.disclosure import (
    rate,
    rate_text,
    rounded_or_null,
    suppress_round,
)

__all__ = [
    "known_code",
    "valid_asof",
    "suppress_round",
    "rounded_or_null",
    "rate",
    "rate_text",
]
