"""Training-data operators: sharding, near-duplicates, archives, language, mixing and scoring.

Nothing outside this subpackage imports it; ``queries`` registers its queries.
"""
