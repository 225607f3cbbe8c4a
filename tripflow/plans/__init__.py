"""Jobs that put sources, operators and tables together."""
