"""Readers. All of them are lazy; none looks at rows to guess a type."""
