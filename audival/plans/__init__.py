"""Model chains (the stored tables and the earlier ad-hoc models), the
query registry and the sinks."""
