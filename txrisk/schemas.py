"""Declared schemas of the input tables, so that reading them needs no inference pass."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


TRANSACTIONS = _table(
    id=T.LongType(),
    date=T.StringType(),
    client_id=T.LongType(),
    card_id=T.LongType(),
    amount=T.StringType(),
    merchant_id=T.LongType(),
    merchant_city=T.StringType(),
    zip=T.StringType(),
    mcc=T.IntegerType(),
    errors=T.StringType(),
)

CARDS = _table(
    id=T.LongType(),
    card_brand=T.StringType(),
    card_type=T.StringType(),
    has_chip=T.StringType(),
    credit_limit=T.StringType(),
    acct_open_date=T.StringType(),
    year_pin_last_changed=T.IntegerType(),
    card_on_dark_web=T.StringType(),
)

USERS = _table(
    id=T.LongType(),
    current_age=T.IntegerType(),
    gender=T.StringType(),
    yearly_income=T.StringType(),
    credit_score=T.IntegerType(),
    num_credit_cards=T.IntegerType(),
)

CODES = _table(mcc_code=T.IntegerType(), mcc_category=T.StringType())

LABELS = _table(transaction_id=T.LongType(), is_fraud=T.BooleanType())
