"""Errors that callers may want to tell apart."""


class ChalklineError(Exception):
    """Any failure with a message for the user."""


class DependencyMissing(ChalklineError):
    """A program or package that a step needs is not there."""


class StageUnavailable(ChalklineError):
    """A stage that this installation cannot run."""


class ProfileError(ChalklineError):
    """A profile that is missing or not valid."""


class ProviderError(ChalklineError):
    """A model provider that cannot be used or failed."""


class CostLimitExceeded(ChalklineError):
    """The estimated cost is over the limit; nothing has been spent."""
