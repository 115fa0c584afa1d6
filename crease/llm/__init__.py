"""Training-data operators: mixing, archives, extraction, chat windows, packing,
deduplication, search, URL filters and quality rules.

Nothing outside this folder imports it; the entry file adds its queries only
when the folder is present.
"""
