"""Errors of pipelines and their parts."""


class TokenforgeError(Exception):
    """Base of all errors of this package."""


class ConfigError(TokenforgeError):
    """A specification that cannot be met."""


class ComponentError(TokenforgeError):
    """A source or sink that cannot be built."""


class UnsupportedEndpointError(TokenforgeError):
    """An endpoint used as a source or sink that it cannot be."""


class NoComponentError(TokenforgeError):
    """A pipeline without what it needs."""
