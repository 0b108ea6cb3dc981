"""Column-level functions: typing, LSNs, names, globs."""
