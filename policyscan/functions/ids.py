"""Column functions over identifiers, severities and error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions import sql
from policyscan.functions.text import let, strip, strip_sql

PARSED_ID = "struct<full_id:string,type:string,provider:string,number:string>"


def _canonical(identifier: Column) -> Column:
    return F.upper(strip(identifier))


def is_strict_id(identifier: Column) -> Column:
    return F.rlike(_canonical(identifier), F.lit(fixed.STRICT_ID))


def parse_id(identifier: Column) -> Column:
    """(full_id, type, provider, number) of a well-formed identifier, else NULL."""

    def parts(full: Column) -> Column:
        pieces = F.split(full, "_", 3)
        return F.when(
            F.rlike(full, F.lit(fixed.STRICT_ID)),
            F.struct(
                full.alias("full_id"),
                pieces[0].alias("type"),
                pieces[1].alias("provider"),
                pieces[2].alias("number"),
            ),
        )

    return let(_canonical(identifier), parts).cast(PARSED_ID)


def accept_sql(identifier: str) -> str:
    """The loose gate used while matching: strict or PREFIX_WORD_REST."""
    full = f"upper({strip_sql(identifier)})"
    return (
        f"(length({identifier}) >= {fixed.MIN_ID_LENGTH} AND"
        f" ({full} RLIKE {sql.string(fixed.LOOSE_ID)} OR {full} RLIKE {sql.string(fixed.STRICT_ID)}))"
    )


_TOKEN = rf"{fixed.LOOSE_ID}|{fixed.STRICT_ID}"


def accept_token_sql(token: str) -> str:
    """``accept_sql`` of a token of ``[A-Z0-9_]``, which needs no trimming and is in upper case."""
    return f"(length({token}) >= {fixed.MIN_ID_LENGTH} AND {token} RLIKE {sql.string(_TOKEN)})"


def accept_id(identifier: str) -> Column:
    """``accept_sql`` of a column."""
    return F.expr(accept_sql(identifier))


def parse_severity(level: Column) -> Column:
    """Upper-cased level when it is one of the five, else NULL."""
    name = F.upper(level)
    return F.when(name.isin(fixed.SEVERITIES), name)


def severity_rank(level: Column) -> Column:
    """4 for CRITICAL down to 0 for INFO, NULL for anything else."""
    rank = F.lit(None).cast("int")
    for name, value in fixed.SEVERITY_RANK.items():
        rank = F.when(level == name, F.lit(value)).otherwise(rank)
    return rank


def error_category(message: Column) -> Column:
    """Class of an error message; the first rule that fits decides."""
    text = F.lower(message)

    def has(word: str) -> Column:
        return F.contains(text, F.lit(word))

    absent = has("not found") | has("missing")
    return (
        F.when(has("checkov id") & absent, "missing_checkov_id")
        .when(has("severity") & absent, "missing_severity")
        .when(has("invalid") & has("checkov"), "invalid_checkov_id")
        .when(has("invalid") & has("severity"), "invalid_severity")
        .when(has("permission") | has("access"), "permission_error")
        .when(has("encoding") | has("unicode"), "encoding_error")
        .when(has("timeout"), "timeout_error")
        .otherwise("other_error")
    )
