"""Trusted-layer transforms: clean text, split names, compute ages.

Each is a single ``select`` of built-in expressions (one codegen stage, no shuffle).
Column names default to the card domain and can be renamed per call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import age_years
from tessera.functions.text import normalize, split_name


def clean(df: DataFrame, keep: Sequence[str], normalized: Sequence[str]) -> DataFrame:
    """Keep ``keep`` as is and ``normalize`` the ``normalized`` columns, in input order."""
    cols = []
    for c in df.columns:
        if c in normalized:
            cols.append(normalize(c).alias(c))
        elif c in keep:
            cols.append(F.col(c))
    return df.select(*cols)


def trusted_holder(raw: DataFrame, *, id: str = "holder_id", name: str = "full_name",
                   birth: str = "birth_date",
                   normalized: Sequence[str] = ("marital_status", "education"),
                   first: str = "first_name", last: str = "last_name", age: str = "age",
                   as_of: Column | None = None) -> DataFrame:
    """Holder: name split into first / rest, text normalised, age from the birth date."""
    fn, ln = split_name(name)
    return raw.select(F.col(id), fn.alias(first), ln.alias(last), F.col(birth),
                      *[normalize(c).alias(c) for c in normalized],
                      age_years(birth, as_of).alias(age))


def trusted_account(raw: DataFrame, *,
                    keep: Sequence[str] = ("account_id", "holder_id", "opened_on"),
                    normalized: Sequence[str] = ("account_type", "branch", "status")
                    ) -> DataFrame:
    return clean(raw, keep, normalized)


def trusted_card(raw: DataFrame, *,
                 keep: Sequence[str] = ("card_id", "account_id", "card_number", "issued_on"),
                 normalized: Sequence[str] = ("printed_name", "brand", "card_type")
                 ) -> DataFrame:
    """Card: text normalised; the card number is passed through untouched."""
    return clean(raw, keep, normalized)


def trusted_movement(raw: DataFrame, *,
                     keep: Sequence[str] = ("movement_id", "card_id", "amount", "moved_at"),
                     normalized: Sequence[str] = ("description",)) -> DataFrame:
    """Movement: description normalised; amount and time untouched."""
    return clean(raw, keep, normalized)
