"""Operators over pages, files, companies and the ledger."""
