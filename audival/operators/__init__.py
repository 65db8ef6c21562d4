"""DataFrame -> DataFrame operators of the lifetime-value models."""
