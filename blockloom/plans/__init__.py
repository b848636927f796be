"""Ranges, work slices and the catalog: what a query covers, before it runs."""
