"""Errors raised by the library."""


class SourceNotFound(FileNotFoundError):
    """A CSV source path does not exist; the message names the path."""

    def __init__(self, path: str):
        super().__init__(f"source not found: {path}")
        self.path = path


class HeaderMismatch(ValueError):
    """Files of one CSV source disagree on their header."""


class EncodingError(ValueError):
    """A source holds bytes that are not valid in the declared encoding."""


class DataLossError(RuntimeError):
    """Requested topic offsets are missing (deleted, never written or skipped)."""
