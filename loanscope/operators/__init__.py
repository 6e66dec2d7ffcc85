"""Reusable DataFrame operators: joins, flag aggregates, top-1, shares, reshaping."""
