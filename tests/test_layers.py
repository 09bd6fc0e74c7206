import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators import (trusted_account, trusted_card, trusted_holder,
                               trusted_movement)


def test_trusted_holder(spark):
    raw = spark.createDataFrame(
        [("H1", "  maria  da silva", dt.date(1990, 5, 1), " viúva", None)],
        "holder_id string, full_name string, birth_date date, marital_status string, "
        "education string")
    out = trusted_holder(raw, as_of=F.lit(dt.date(2025, 5, 1)))
    assert out.columns == ["holder_id", "first_name", "last_name", "birth_date",
                           "marital_status", "education", "age"]
    r = out.first()
    assert (r.first_name, r.last_name, r.marital_status, r.education, r.age) == (
        "MARIA", " DA SILVA", "VIÚVA", "", 35)


def test_trusted_account_card_movement(spark):
    acct = spark.createDataFrame([("A1", "H1", " corrente", None, "Ativa ", dt.date(2020, 1, 2))],
                                 "account_id string, holder_id string, account_type string, "
                                 "branch string, status string, opened_on date")
    a = trusted_account(acct).first()
    assert tuple(a) == ("A1", "H1", "CORRENTE", "", "ATIVA", dt.date(2020, 1, 2))
    card = spark.createDataFrame(
        [("C1", "A1", " 0001 ", "nome 1", "visa", "\tcredito", dt.date(2023, 1, 1))],
        "card_id string, account_id string, card_number string, printed_name string, "
        "brand string, card_type string, issued_on date")
    c = trusted_card(card).first()
    # the card number is passed through untouched; a leading tab survives trim
    assert tuple(c) == ("C1", "A1", " 0001 ", "NOME 1", "VISA", "\tCREDITO",
                        dt.date(2023, 1, 1))
    mv = spark.createDataFrame(
        [("M1", "C1", None, Decimal("10.50"), dt.datetime(2025, 8, 14, 10, 30))],
        "movement_id string, card_id string, description string, amount decimal(10,2), "
        "moved_at timestamp")
    m = trusted_movement(mv)
    assert m.columns == ["movement_id", "card_id", "description", "amount", "moved_at"]
    assert tuple(m.first()) == ("M1", "C1", "", Decimal("10.50"), dt.datetime(2025, 8, 14, 10, 30))
    assert dict(m.dtypes)["amount"] == "decimal(10,2)"
