"""Bindings of the operators to the shared test tables, and the SQL that checks them."""
