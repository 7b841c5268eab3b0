"""DataFrame operators of the fare engine."""
