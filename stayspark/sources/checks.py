"""Documents checked against tables of rules: where a rule looks, what must hold there, and what to say if it does not."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

EACH = "*"


class Rule(NamedTuple):
    """`at`: names joined by dots, `*` for each entry of an object or list, "" for the whole document."""

    at: str
    holds: Callable[[Any], object]
    say: str


def places(doc: Any, at: str) -> Iterator[tuple[str, Any]]:
    """The values that a path leads to, with where they are; an absent one is None. What is no container has no entries."""
    found = [("", doc)]
    for step in filter(None, at.split(".")):
        nearer = []
        for where, value in found:
            if step == EACH:
                entries = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
                nearer += [(f"{where}.{k}", v) for k, v in entries]
            elif isinstance(value, dict):
                nearer.append((f"{where}.{step}", value.get(step)))
        found = nearer
    return ((where.lstrip("."), value) for where, value in found)


def check(doc: Any, rules: tuple[Rule, ...], what: str) -> None:
    """All faults in one ValueError, in the order of the rules."""
    faults = [f"{where}: {rule.say}" if where else rule.say for rule in rules for where, value in places(doc, rule.at) if not rule.holds(value)]
    if faults:
        raise ValueError(f"{what}: {'; '.join(faults)}")


def text(v: Any) -> bool:
    return isinstance(v, str) and not v.isspace() and v != ""


def counted(v: Any) -> bool:
    """A whole number of one or more; true is none."""
    return type(v) is int and v > 0


def one_of(*values: Any) -> Callable[[Any], bool]:
    return lambda v: any(type(v) is type(x) and v == x for x in values)


def filled(kind: type) -> Callable[[Any], bool]:
    return lambda v: isinstance(v, kind) and len(v) > 0
