"""Registered queries: test tables in their roles, one query per operator, SQL to compare with."""
