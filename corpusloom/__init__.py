"""Text-corpus analytics expressed as Spark DataFrame transformations."""
