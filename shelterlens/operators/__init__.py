"""Reusable DataFrame -> DataFrame operators: month spine, order-safe dedup, ordered-event joins."""
