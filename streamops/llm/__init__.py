"""Operators for preparing training text: extraction, archives, near-duplicates,
secrets, personal data, language, perplexity, contamination, quality, packing.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only where the package is present."""
