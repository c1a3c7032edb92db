"""Composable Spark operators that turn a social event log into geographic marts."""
