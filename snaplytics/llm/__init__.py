"""Training-data operators: mixing, scoring, filtering, dedup, extraction, tokenising, archives.

Nothing else in the package imports this subpackage; ``__spark_entry__.py`` adds
its queries when it is present.
"""
