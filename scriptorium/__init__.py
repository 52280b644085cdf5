"""A PySpark engine for structured text corpora: parse, address, link, compare, check, render."""
