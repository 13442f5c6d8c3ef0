"""What can go wrong. Every message is complete by itself; nothing else is attached."""

from __future__ import annotations


class DaybookError(Exception):
    """Any failure that this package reports on purpose."""


class ParamError(DaybookError, ValueError):
    """A parameter is out of bounds or contradicts another one."""


class SchemaError(DaybookError):
    """An input file is absent, empty, unparseable or lacks required columns."""

    #: canonical names of the columns that are missing, if that is the reason
    missing: tuple[str, ...] = ()


class DataQualityError(DaybookError):
    """Too large a share of the input rows was rejected."""


class CurrencyError(DaybookError):
    """No rate is configured for a source currency."""
