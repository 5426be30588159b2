"""The error raised when a request itself is wrong (not when data is)."""


class QueryError(ValueError):
    """A request that the operators refuse, such as ``eq`` on a text field."""
