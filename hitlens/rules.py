"""Ordered classification rules.

A rule list is plain data: ``[(label, regex), ...]``, first match wins. It becomes one
``CASE WHEN`` column, so classification stays inside whole-stage codegen.

Regexes are the main cost of classifying log rows, so :func:`found` tests the literal text a
pattern needs first (a plain byte search), and runs the regex only where that text occurs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Iterable[tuple[str, str]]


def _alternatives(pattern: str) -> list[str]:
    """Top-level alternatives of a pattern, one pair of outer parentheses removed."""
    if pattern.startswith("(") and not pattern.startswith("(?") and _group_end(pattern, 0) == len(pattern) - 1:
        pattern = pattern[1:-1]
    parts, start, i = [], 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 1
        elif ch in "([":
            i = _group_end(pattern, i)
        elif ch == "|":
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*parts, pattern[start:]]


def _group_end(pattern: str, at: int) -> int:
    """Index of the bracket that closes the one at ``at``."""
    close, depth, i = {"(": ")", "[": "]"}[pattern[at]], 0, at
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
        elif pattern[i] == pattern[at]:
            depth += 1
        elif pattern[i] == close:
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError(f"unbalanced pattern: {pattern}")


def _literals(part: str) -> tuple[list[str], bool]:
    """Literal runs every match must contain, and whether the part is literal throughout."""
    runs, run, plain, i = [], "", True, 0
    while i < len(part):
        ch = part[i]
        if ch == "\\" and not part[i + 1].isalnum():
            run, i = run + part[i + 1], i + 2
            continue
        if ch not in "\\.[]()*+?{}^$":
            run, i = run + ch, i + 1
            continue
        plain = False
        if ch in "*?{":
            run = run[:-1]
        runs.append(run)
        run = ""
        if ch in "([":
            i = _group_end(part, i)
        elif ch == "{":
            i = part.index("}", i)
        elif ch == "\\":
            i += 1
        i += 1
    return [r for r in (*runs, run) if r], plain


def _tests(pattern: str) -> list[tuple[str, list[str], str]]:
    """What a pattern comes down to: (kind, literals, regex); kinds are contains, startswith, endswith and rlike."""
    if pattern.startswith("(?"):
        return [("rlike", [], pattern)]
    tests, regexes = [], []
    for part in _alternatives(pattern):
        runs, plain = _literals(part)
        if plain and runs:
            tests.append(("contains", runs[:1], ""))
        elif runs and part.startswith("^") and _literals(part[1:]) == (runs, True):
            tests.append(("startswith", runs[:1], ""))
        elif runs and part.endswith("$") and _literals(part[:-1]) == (runs, True):
            tests.append(("endswith", runs[:1], ""))
        elif runs:
            tests.append(("rlike", list(dict.fromkeys(runs)), part))
        else:
            regexes.append(part)
    return [*tests, ("rlike", [], "|".join(regexes))] if regexes else tests


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_test(column: str, pattern: str) -> str:
    """The tests of a pattern as SQL over a named column."""

    def one(kind: str, literals: list[str], regex: str) -> str:
        plain = [f"{'contains' if kind == 'rlike' else kind}(`{column}`, {_quoted(text)})" for text in literals]
        return "(" + " AND ".join([*plain, f"`{column}` RLIKE {_quoted(regex)}"] if kind == "rlike" else plain) + ")"

    return "(" + " OR ".join(one(*test) for test in _tests(pattern)) + ")"


def found(subject: Column | str, pattern: str) -> Column:
    """``subject`` contains a match of ``pattern``; same result as ``rlike``, usually much cheaper.

    A column given by its name becomes one SQL expression: the same plan, built in one call to the JVM.
    """
    if isinstance(subject, str):
        return F.expr(_sql_test(subject, pattern))

    def one(kind: str, literals: list[str], regex: str) -> Column:
        plain = [getattr(subject, "contains" if kind == "rlike" else kind)(text) for text in literals]
        return reduce(lambda a, b: a & b, [*plain, subject.rlike(regex)] if kind == "rlike" else plain)

    return reduce(lambda a, b: a | b, [one(*test) for test in _tests(pattern)])


def first_match(subject: Column | str, rules: Rules, default: str | None = None) -> Column:
    """Label of the first rule whose regex is found in ``subject`` (a column, or its name as in :func:`found`)."""
    rules = list(rules)
    if isinstance(subject, str) and rules:
        arms = " ".join(f"WHEN {_sql_test(subject, pattern)} THEN {_quoted(label)}" for label, pattern in rules)
        return F.expr(f"CASE {arms} ELSE {'NULL' if default is None else _quoted(default)} END")
    out = None
    for label, pattern in rules:
        test = found(subject, pattern)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def ladder(value: Column, steps: Iterable[tuple[float, object]], top: object, *, strict: bool = False) -> Column:
    """``value <= bound`` (or ``<`` when strict) picks the step's label, else ``top``."""
    out = None
    for bound, label in steps:
        test = value < F.lit(bound) if strict else value <= F.lit(bound)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(top))


def descend(value: Column, steps: Iterable[tuple[float, object]], bottom: object, *, strict: bool = True) -> Column:
    """``value > bound`` (or ``>=`` when not strict) picks the step's label, else ``bottom``."""
    out = None
    for bound, label in steps:
        test = value > F.lit(bound) if strict else value >= F.lit(bound)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(bottom))


def lookup(key: Column, table: Mapping[str, object], default: object) -> Column:
    """Small fixed map as ``CASE`` on equality."""
    out = None
    for k, v in table.items():
        test = key == F.lit(k)
        out = F.when(test, F.lit(v)) if out is None else out.when(test, F.lit(v))
    return out.otherwise(F.lit(default))


def starts_with_any(subject: Column, prefixes: Iterable[str]) -> Column:
    """Any of a list of literal prefixes."""
    return reduce(lambda a, b: a | b, [subject.startswith(p) for p in prefixes])


def column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def lowered_text(text: Column | str, lowered: bool) -> Column | str:
    """Lower-cased text for a rule list; a rule list reads it once per rule, so callers may pass it lowered."""
    return text if lowered else F.lower(text)


def present(text: Column) -> Column:
    """Header text, or NULL where it is absent, empty or the ``-`` placeholder."""
    return F.when((text != "") & (text != "-"), text)


def settled(df, columns: Mapping[str, Column], keep: Iterable[str]):
    """Project ``keep`` and ``columns`` so that later filters cannot pull these expressions down.

    A filter over costly columns is otherwise pushed below them and computes them twice. The
    one-row generator is a plan boundary the optimizer keeps; it adds no shuffle.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
