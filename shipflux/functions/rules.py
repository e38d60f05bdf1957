"""First-match rules and value bands as single SQL CASE expressions.

The functions return SQL text. A rule table becomes one `expr` call, which keeps
building a plan with hundreds of rules fast, and one CASE in the generated code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple


class Rule(NamedTuple):
    """All columns in `when` must match; a tuple of values means any of them."""

    when: Mapping[str, object]
    then: str


def literal(value: object) -> str:
    """A SQL literal; floats are doubles, None is an untyped NULL."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def case(cases: Iterable[tuple[str, str]], otherwise: str | None = None) -> str:
    """CASE over (condition, value) texts; NULL when nothing matches and no default is given."""
    arms = [f"WHEN {condition} THEN {value}" for condition, value in cases]
    if otherwise is not None:
        arms.append(f"ELSE {otherwise}")
    return f"(CASE {' '.join(arms)} END)"


def matches(when: Mapping[str, object], columns: Mapping[str, str]) -> str:
    def test(name: str, wanted: object) -> str:
        if isinstance(wanted, tuple):
            return f"{columns[name]} IN ({', '.join(literal(value) for value in wanted)})"
        return f"{columns[name]} = {literal(wanted)}"

    return " AND ".join(test(name, wanted) for name, wanted in when.items())


def decide(
    rules: Sequence[Rule],
    columns: Mapping[str, str],
    value_of: Callable[[str], str] = literal,
    otherwise: str | None = None,
) -> str:
    """Compile a rule table; `value_of` turns the `then` text into SQL."""
    return case(((matches(rule.when, columns), value_of(rule.then)) for rule in rules), otherwise)


def bands(column: str, edges: Sequence[float], labels: Sequence, otherwise, above_first=False) -> str:
    """Label `i` for edges[i] <= column < edges[i+1]; the last band is open.

    With `above_first` the lowest edge itself is outside the first band.
    """
    lowest = f"{column} {'>' if above_first else '>='} {edges[0]}"
    inner = [(f"{column} < {upper}", literal(label)) for upper, label in zip(edges[1:], labels)]
    inside = case(inner, case([(f"{column} >= {edges[-1]}", literal(labels[-1]))]))
    return case([(lowest, inside)], literal(otherwise))
