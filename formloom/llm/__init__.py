"""Training-data operators: deduplication, archives, scans, decontamination, packing, scoring.

Nothing outside this subpackage imports it.
"""
