"""Document formats in plain Python: bytes in, values out, no Spark."""


class DocumentError(ValueError):
    """A document that can't be read or written as asked."""
