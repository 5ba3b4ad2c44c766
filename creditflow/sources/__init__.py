"""Readers (logical tables, stand-ins), the delivery ledger and the CSV export."""
