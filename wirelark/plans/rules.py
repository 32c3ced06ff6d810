"""The order in which a telegram's fields are read, and how users add scans, rules and fields of their own (section 2.10).

A rule runs when ``when`` gives something true, which ``then`` gets. Rules of a higher priority run first; within a
priority a rule runs behind all it names in ``after``, else in the order of registration. A registry never changes: each
addition gives a new one, so the rules that come with this package stay as they are. It travels to the workers with the
job, so scans and rules may be any functions that can be pickled.

    rules = DEFAULT.with_scan(pattern_scan("extension", r"^EXT ([0-9]+)$")).with_rule(
        Rule("extension", then=lambda b, found: b.record.update(extension=found[0][1]), when=lambda b: b.matches("extension"),
             priority=31, after=("drafting",))
    ).with_field("extension", "string")
    extracted(texts, rules=rules)
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from typing import Any

#: Priorities of the rules that come with the package: the raw body, what is cut out of it, marks, distribution, the
#: message's group and addressees, header fields, and the content at the end.
RAW, PAGES, ENDS, CONTENT, SECTIONS, DISTRIBUTION, GROUP, FIELDS, REMOVAL = 144, 128, 112, 96, 80, 64, 32, 31, 16


def always(body: Any) -> bool:
    return True


@dataclass(frozen=True)
class Rule:
    """``then(body, found)`` for what ``when(body)`` found.

    ``gives``: the record's fields that it sets or changes; ``leans``: rules beside ``after`` whose cuts or spans it reads.
    ``asks``: those of both that it reads in some telegrams alone; it calls ``body.ask`` with its name before.
    Where a rule does not say what it gives, all rules run, whatever fields are asked for.
    """

    name: str
    then: Callable[[Any, Any], None]
    when: Callable[[Any], Any] = always
    priority: int = FIELDS
    after: tuple[str, ...] = ()
    gives: tuple[str, ...] | None = None
    leans: tuple[str, ...] = ()
    asks: tuple[str, ...] = ()


@dataclass(frozen=True)
class Scan:
    """Finds matches in the body when it has been cut (``raw``: before); a match has span(), and groups by number."""

    name: str
    find: Callable[[str], Iterable[re.Match]]
    raw: bool = False


def pattern_scan(name: str, pattern: str | re.Pattern, raw: bool = False) -> Scan:
    """A scan for all matches of a pattern, lines on their own."""
    compiled = re.compile(pattern, re.MULTILINE) if isinstance(pattern, str) else pattern
    return Scan(name, compiled.finditer, raw)


@dataclass(frozen=True)
class Rules:
    """Scans, rules and the DDL of fields that a record has beside the package's own."""

    scans: tuple[Scan, ...] = ()
    rules: tuple[Rule, ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    #: Rules that run in a telegram only where another one asks for what they find.
    held: frozenset[str] = frozenset()
    order: tuple[Rule, ...] = field(default=(), compare=False)
    #: Of each rule that asks, the held ones that lead to what it asks for, in order.
    behind: dict[str, tuple[Rule, ...]] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        for kind, names in (("scan", [s.name for s in self.scans]), ("rule", [r.name for r in self.rules]), ("field", [n for n, _ in self.fields])):
            twice = sorted({n for n in names if names.count(n) > 1})
            if twice:
                raise ValueError(f"registered twice as a {kind}: {', '.join(twice)}")
        order = ordered(self.rules)
        object.__setattr__(self, "order", tuple(r for r in order if r.name not in self.held))
        paths = {r.name: self._reached(r.asks, True) & self.held for r in order if r.asks} if self.held else {}
        object.__setattr__(self, "behind", {name: tuple(r for r in order if r.name in path) for name, path in paths.items()})

    def with_scan(self, scan: Scan) -> Rules:
        return replace(self, scans=(*self.scans, scan))

    def with_rule(self, rule: Rule) -> Rules:
        return replace(self, rules=(*self.rules, rule))

    def with_field(self, name: str, ddl: str) -> Rules:
        return replace(self, fields=(*self.fields, (name, ddl)))

    def without_rule(self, name: str) -> Rules:
        return replace(self, rules=tuple(r for r in self.rules if r.name != name))

    def giving(self, fields: Iterable[str]) -> Rules:
        """The rules that some fields of a record need; the others are left out."""
        if any(r.gives is None for r in self.rules):
            return self
        asked = set(fields)
        first = [r.name for r in self.rules if asked.intersection(r.gives)]
        needed, may = self._reached(first, False), self._reached(first, True)
        return replace(self, rules=tuple(r for r in self.rules if r.name in may), held=frozenset(may - needed))

    def _reached(self, names: Iterable[str], asking: bool) -> set[str]:
        """Some rules and all that they lean on; what they may ask for too, or not."""
        known, out, more = {r.name: r for r in self.rules}, set(), list(names)
        while more:
            name = more.pop()
            if name in known and name not in out:
                out.add(name)
                rule = known[name]
                more += [n for n in (*rule.after, *rule.leans) if asking or n not in rule.asks]
        return out

    def run(self, body: Any) -> None:
        _applied(self.order, body)

    def run_for(self, name: str, body: Any) -> None:
        """The held rules that a rule asks for."""
        _applied(self.behind.get(name, ()), body)


def _applied(rules: Iterable[Rule], body: Any) -> None:
    for rule in rules:
        found = rule.when(body)
        if found:
            rule.then(body, found)


def ordered(rules: Iterable[Rule]) -> list[Rule]:
    """Rules by falling priority, within one behind all that they name; refuses what has no such order."""
    rules = list(rules)
    known = {r.name: r for r in rules}
    for r in rules:
        for name in r.after:
            if name not in known:
                raise ValueError(f"rule {r.name} runs after {name}, which is not registered")
            if known[name].priority < r.priority:
                raise ValueError(f"rule {r.name} of priority {r.priority} cannot run after {name} of priority {known[name].priority}")
    out: list[Rule] = []
    for priority in sorted({r.priority for r in rules}, reverse=True):
        tier = [r for r in rules if r.priority == priority]
        waits = {r.name: {a for a in r.after if known[a].priority == priority} for r in tier}
        while tier:
            free = next((r for r in tier if not waits[r.name]), None)
            if free is None:
                raise ValueError(f"rules wait for each other: {', '.join(sorted(r.name for r in tier))}")
            tier.remove(free)
            out.append(free)
            for waiting in waits.values():
                waiting.discard(free.name)
    return out
