"""Registered queries over the driver's tables, each with an SQL twin where one exists."""
