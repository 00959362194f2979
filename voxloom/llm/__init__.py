"""Training-data operators: search, sharding, token counts, near-duplicates, media, BPE, language, quality, packing, licences.

Nothing outside this subpackage imports it; it can be removed whole.
"""
