"""Readers and writers: sheets, catalogue tables, vendor feeds, ledger, product feeds, reports."""
