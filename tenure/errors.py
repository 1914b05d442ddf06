"""The one error type of the library."""


class DataQualityError(ValueError):
    """The input cannot be processed: unreadable, missing columns, or fatal rule hits."""
