"""Failures that belong to the operators."""


class TidemarkError(Exception):
    """Base of every error raised on purpose by this package."""


class MergeKeysError(TidemarkError):
    """An upsert was asked for without merge keys."""


class SchemaChangeError(TidemarkError):
    """A table cannot be brought to its declaration without losing data."""


class QualityGateError(TidemarkError):
    """The share of rejected rows is above the allowed limit."""


class QuarantineError(TidemarkError):
    """Rejected rows could not be written."""


class NothingToDo(TidemarkError):
    """The increment is empty; callers treat this as success."""


class NotNullError(TidemarkError):
    """A column that must be filled holds nulls."""


class MetricsMissingError(TidemarkError):
    """No quality metrics are stored for the run date."""
