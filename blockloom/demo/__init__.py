"""The sales tables seen as chains, and the queries that are checked against SQL."""
