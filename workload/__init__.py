"""Queries over the test tables, one or more per operator, with equivalent SQL."""
