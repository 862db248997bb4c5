"""Placeholders in trees of plain values: "{{ name }}" and "{{ name | type }}".

A text that is nothing but a placeholder becomes the argument as it is; inside a longer
text the argument has to be a text.  Keys of dictionaries have placeholders as well.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from ..errors import InvalidArgument, MissingArgument

_HOLE = re.compile(r"\{\{\s*([^{}|]*?)\s*(?:\|[^{}]*)?\}\}")


def interpolate(tree: Any, arguments: Mapping[str, Any]) -> Any:
    if isinstance(tree, str):
        return _text(tree, arguments)
    if isinstance(tree, Mapping):
        return {_key(k, arguments): interpolate(v, arguments) for k, v in tree.items()}
    if isinstance(tree, (list, tuple)):
        return [interpolate(v, arguments) for v in tree]
    return tree


def placeholders(tree: Any) -> set[str]:
    """Names of the arguments that a tree asks for."""
    if isinstance(tree, str):
        return set(_HOLE.findall(tree))
    if isinstance(tree, Mapping):
        return set().union(*[placeholders(k) | placeholders(v) for k, v in tree.items()])
    if isinstance(tree, (list, tuple)):
        return set().union(*map(placeholders, tree))
    return set()


def _argument(name: str, arguments: Mapping[str, Any]) -> Any:
    if name not in arguments:
        raise MissingArgument(f'no argument "{name}"')
    return arguments[name]


def _text(text: str, arguments: Mapping[str, Any]) -> Any:
    if whole := _HOLE.fullmatch(text):
        return _argument(whole[1], arguments)

    def put(m: re.Match) -> str:
        value = _argument(m[1], arguments)
        if not isinstance(value, str):
            raise InvalidArgument(f'argument "{m[1]}" stands inside a text and has to be one')
        return value

    return _HOLE.sub(put, text)


def _key(key: str, arguments: Mapping[str, Any]) -> str:
    out = _text(key, arguments)
    if not isinstance(out, str):
        raise InvalidArgument(f"{key} is a key and needs a text")
    return out
