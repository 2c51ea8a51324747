"""Errors raised while a request is being built, before any job starts."""


class QuarryError(ValueError):
    """Base class of the library's own errors."""


class FieldError(QuarryError):
    """Unknown field, unusable field kind, or a bad field declaration."""


class LiteralError(QuarryError):
    """A literal whose type does not fit the field it is compared with."""


class RequestError(QuarryError):
    """A query, sort or aggregation that cannot be expressed."""
