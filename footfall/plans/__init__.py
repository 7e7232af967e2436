"""Plans over the operators: sinks, the daily run, the named query catalog."""
