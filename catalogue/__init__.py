"""Registered queries over the given tables, with the SQL that says what each must return."""
