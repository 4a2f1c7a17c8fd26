"""DataFrame operators the impression query is composed of."""
