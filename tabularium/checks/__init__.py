"""Registered queries: every operator exercised on the given tables, with its SQL where SQL can say it."""
