"""Operators for preparing training text: archives, duplicates, filters, models, mixing."""
