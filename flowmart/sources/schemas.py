"""Schemas of the ledgers, as DDL text."""

from __future__ import annotations


FEED_LEDGER = "path string, landed_at timestamp, loaded_at timestamp"

LEDGER = "source_file string, row_count bigint, loaded_at timestamp"
