"""Reusable DataFrame operators behind the reports."""
