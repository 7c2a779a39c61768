"""Training-data operators: search, formatting, packing, extraction, filters, joins and scans over text tables."""
