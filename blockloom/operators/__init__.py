"""DataFrame -> DataFrame operators: row preparation, table builders and the event join."""
