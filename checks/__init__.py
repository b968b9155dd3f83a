"""Registered queries over the driver's tables, and the SQL each one must agree with."""
