"""Errors raised while a query is being set up, before any Spark job runs."""


class InvalidArgument(ValueError):
    """A range, position or size that makes no sense."""


class NotFound(LookupError):
    """A table or chain that does not exist, or an event log or block store that is empty."""
