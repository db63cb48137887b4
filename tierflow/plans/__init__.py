"""Whole jobs: silver and gold tables and the reports on them."""
