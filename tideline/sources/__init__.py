"""Sources and sinks, table schemas, and views over the standard tables."""
