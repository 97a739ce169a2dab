"""What the library raises where its input breaks a contract."""

from __future__ import annotations


class DataContractError(ValueError):
    """The input lacks or contradicts something that an operator needs."""


class MissingInputError(FileNotFoundError):
    """A named file, mask or model isn't there."""


class EmptyInputError(RuntimeError):
    """Nothing to work on."""
