"""Operators for preparing training data: packing, decontamination, deduplication,
quality rules, archives, licence scans, language identification and token counts.

Nothing else in the library imports this subpackage.
"""
