"""Operators for preparing training text: packing, filters, duplicates, search, token files, chat."""
