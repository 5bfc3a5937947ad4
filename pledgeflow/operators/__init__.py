"""Audits, rules, ingest, refunds and table maintenance."""
