"""Audience lifetime value on Spark: DataFrame operators for login-state and
loyalty splits, customer estimates, advertising and subscription value,
weighted roll-ups and declarative reports."""
