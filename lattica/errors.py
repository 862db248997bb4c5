"""Errors, each with the HTTP status that a service would answer with."""


class EngineError(Exception):
    status = 500


class BadQuery(EngineError):
    """The query cannot be meant: unknown names, wrong shapes, wrong argument values."""

    status = 400


class InvalidColumnIndex(BadQuery):
    pass


class ExpressionTooDeep(BadQuery):
    pass


class UnsupportedExpression(BadQuery):
    pass


class UnsupportedRelation(BadQuery):
    pass


class UnsupportedJoin(BadQuery):
    pass


class InvalidUnion(BadQuery):
    pass


class UnknownCollection(BadQuery):
    pass


class UnknownField(BadQuery):
    pass


class FunctionAsTable(BadQuery):
    """A view with one value was used where rows are needed."""


class UnknownArgument(BadQuery):
    pass


class MissingArgument(BadQuery):
    pass


class InvalidArgument(BadQuery):
    pass


class NotSupported(EngineError):
    status = 501


class SchemaError(EngineError):
    """A schema or configuration that does not hold together."""


class ResponseMismatch(EngineError):
    """A value does not have its declared type."""


def error_response(error: Exception) -> tuple[int, dict]:
    """Status and body for an error; what is not ours is an internal error."""
    status = error.status if isinstance(error, EngineError) else 500
    return status, {"message": str(error), "type": type(error).__name__}
