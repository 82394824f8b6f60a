"""Operators that prepare text for language-model training: filters, duplicates, extraction, mixing."""
