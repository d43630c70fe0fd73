"""Whole plans: both passes, the registered queries and their SQL."""
