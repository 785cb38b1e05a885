"""Configurations of the driver as layers of settings.

A layer maps the path of a setting (its keys from the root) to a value.  Defaults, a YAML document and variables
of the environment are layers; a later one wins, path by path.  Only the result becomes a tree again.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Mapping
from pathlib import Path

try:  # without it, documents and values are read as JSON
    import yaml
except ImportError:
    yaml = None

# The form of a placeholder and the scopes of variables.
PLACEHOLDER = re.compile(r"\s*\$\{([A-Za-z_]\w*)(?::([^}]*))?\}\s*", re.ASCII)
SCOPES = ("train", "gen", "paths")

Layer = dict[tuple[str, ...], object]


def read_value(text: str, strict: bool = False):
    """A document or a single value; text that isn't one stays text, unless `strict`."""
    errors = (ValueError, yaml.YAMLError) if yaml else (ValueError,)
    try:
        return yaml.safe_load(text) if yaml else json.loads(text or "null")
    except errors:
        if strict:
            raise
        return text


def layer_of(tree: Mapping, at: tuple[str, ...] = ()) -> Layer:
    """The settings of a tree of mappings; an empty mapping is a setting."""
    out: Layer = {}
    for key, value in tree.items():
        out |= layer_of(value, (*at, key)) if isinstance(value, Mapping) and value else {(*at, key): value}
    return out


def stacked(layers: Iterable[Layer]) -> dict:
    """The tree of all layers: a setting takes the place of those above and below it that came before."""
    found: Layer = {}
    for layer in layers:
        for path, value in layer.items():
            below = [p for p in found if p[: len(path)] == path and len(p) > len(path)]
            if value == {} and below:
                continue
            for old in [*below, *(path[:k] for k in range(1, len(path)))]:
                found.pop(old, None)
            found[path] = value
    tree: dict = {}
    for path, value in found.items():
        node = tree
        for key in path[:-1]:
            node = node.setdefault(key, {})
        node[path[-1]] = value
    return tree


def filled(layer: Layer, env: Mapping[str, str]) -> Layer:
    """Values that are one placeholder, `${NAME}` or `${NAME:default}`, from the environment; the empty string where there is neither."""

    def one(value):
        if isinstance(value, list):
            return [one(x) for x in value]
        if isinstance(value, Mapping):
            return {k: one(v) for k, v in value.items()}
        asked = PLACEHOLDER.fullmatch(value) if isinstance(value, str) else None
        text = env.get(asked[1], asked[2]) if asked else None
        return value if asked is None else "" if text is None else read_value(text)

    return {path: one(value) for path, value in layer.items()}


def layer_of_variables(scope: str = "", prefix: str = "PALAVER_CFG__", env: Mapping[str, str] = os.environ) -> Iterator[Layer]:
    """A layer for each variable `<prefix>[<scope>__]<key>__...`; those of other scopes give none."""
    for name in (n for n in env if n.startswith(prefix)):
        path = tuple(name.removeprefix(prefix).lower().split("__"))
        other = bool(scope) and path[0] in SCOPES
        if other and path[0] == scope:
            path, other = path[1:], False
        if path and all(path) and not other:
            value = read_value(env[name])
            yield layer_of({path[0]: value}) if len(path) == 1 else layer_of(value, path) if isinstance(value, Mapping) and value else {path: value}


def overridden(config: Mapping, scope: str = "", prefix: str = "PALAVER_CFG__", env: Mapping[str, str] = os.environ) -> dict:
    """The configuration under the variables that set its keys."""
    return stacked([layer_of(config), *layer_of_variables(scope, prefix, env)])


def load(path: str, defaults: Mapping | None = None, env: Mapping[str, str] = os.environ) -> dict:
    """The document over the defaults, with placeholders filled; without a document, the defaults."""
    file = Path(path)
    own = read_value(file.read_text(encoding="utf-8"), strict=True) if file.exists() else None
    if own is not None and not isinstance(own, Mapping):
        raise ValueError(f"a mapping is needed: {path}")
    return stacked(filled(layer, env) for layer in (layer_of(defaults or {}), layer_of(own or {})))


#: A line of a file of variables: a name, an equals sign, a value in the same quotes on both sides or in none.
ASSIGNMENT = re.compile(r"^[ \t]*(?!#)([^=\n]*?)[ \t]*=[ \t]*([\"']*)(.*?)[\"']*[ \t\r]*$", re.MULTILINE)


def dotenv(path: str) -> dict[str, str]:
    """Assignments of a file of variables, without the values' quotes; a missing file has none."""
    file = Path(path)
    return {m[1]: m[3] for m in ASSIGNMENT.finditer(file.read_text(encoding="utf-8-sig"))} if file.exists() else {}


def chosen(given, configured, default, least=None):
    """The given value, else the configured one, else the default, at least `least`; a negative number counts as unset."""
    unset = lambda v: v is None or isinstance(v, int) and not isinstance(v, bool) and v < 0
    value = next((v for v in (given, configured) if not unset(v)), default)
    return value if least is None else max(least, value)


def require(name: str, n: int, least: int) -> int:
    """The number, if it is large enough to go on with."""
    if n < least:
        raise ValueError(f"{name}: {n}, at least {least} needed")
    return n


def with_run_name(template: str, run_name: str) -> str:
    """Paths with `{run_name}` in them."""
    return template.format_map({"run_name": run_name})


def context_tokens(override: int | None, configured: int, block: int) -> int:
    """The tokens that a prompt may have: the override or the configured number, at most the block; all of it if neither is positive."""
    asked = override if override is not None else configured
    return min(asked, block) if asked > 0 else block
