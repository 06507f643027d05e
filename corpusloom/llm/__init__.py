"""Operators that prepare training text: near duplicates, leaks, languages, mixtures, defects, encoding, packing, quality.

Nothing outside this subpackage imports it; ``queries`` holds its entries for the driver.
"""
