"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.strip() treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(col: Column) -> Column:
    """Remove Unicode white space from both ends (linear time, unlike an anchored regex)."""
    return F.trim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def mask_email(email: Column, privileged: bool = False) -> Column:
    """``ada@example.com`` -> ``a***@example.com``.

    A value without local part stays as it is, one without domain shows only its first letter.
    Readers with a privileged role see the value itself.
    """
    if privileged:
        return email
    at = F.instr(email, "@")
    hidden = F.concat(F.substring(email, 1, 1), F.lit("***"))
    domain = F.substring(email, at + 1, F.length(email))
    return (
        F.when((at == 1) | (email == ""), email)
        .when((at == 0) | (domain == ""), hidden)
        .otherwise(F.concat(hidden, F.lit("@"), domain))
    )
