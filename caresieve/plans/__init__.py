"""Registered queries over the driver tables, each beside the SQL that must give the same rows."""
