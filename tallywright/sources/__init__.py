"""Readers and generated sources."""

from tallywright.sources.synthetic import id_range, make_transactions, transactions_from_events
from tallywright.sources.tables import (
    card_transactions_from_events,
    event_amount,
    load_card_transactions,
    read_catalog_table,
    read_table,
)

__all__ = [
    "card_transactions_from_events",
    "event_amount",
    "id_range",
    "load_card_transactions",
    "make_transactions",
    "read_catalog_table",
    "read_table",
    "transactions_from_events",
]
