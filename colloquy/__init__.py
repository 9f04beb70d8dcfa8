"""colloquy: curation of two-party conversational speech corpora as PySpark DataFrame transformations."""
