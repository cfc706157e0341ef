from __future__ import annotations

from datetime import datetime

from tallywright.schemas import CARD_TRANSACTIONS

NOON = "2026-07-17 12:00:00"


def card_rows(spark, rows):
    """Rows of (id, customer, time text, amount[, category[, card]])."""
    full = []
    for row in rows:
        tx, customer, at, amount, *rest = row
        category = rest[0] if rest else "Retail"
        card = rest[1] if len(rest) > 1 else "Visa"
        moment = datetime.fromisoformat(at) if at else None
        full.append((tx, customer, moment, amount, category, card, "US"))
    return spark.createDataFrame(full, CARD_TRANSACTIONS)
