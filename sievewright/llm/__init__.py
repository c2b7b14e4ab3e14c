"""Operators for building training corpora, their registered queries and the SQL that checks them."""
