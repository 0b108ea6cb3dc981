"""Operators for preparing training text: formatting, deduplication, personal
data, language, tokenisation and packed output.  Nothing else in the library
imports this subpackage."""
