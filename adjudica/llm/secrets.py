"""Secrets found by one deterministic automaton for all rules, in one pass over the bytes of a text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from re import _constants as ops, _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudica.llm.common import by_bytes, documents, query, small_batches


class Rule(NamedTuple):
    """A kind of secret: a pattern over bytes, and how many bytes its last group (or all of it) must hold at least.

    A pattern ends in fixed text or in an open run of one byte class, so a match ends where no longer one exists.
    Lengths are counted by states only where short matches are common, as in ``hex``: counts of several rules that
    may run side by side would multiply the states.
    """

    kind: str
    pattern: bytes
    least: int = 0


# The patterns of the contract, in its order.
BASE = (
    Rule("assign", rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    Rule("access", rb"AKIA[A-Z0-9]+", 20),
    Rule("hex", rb"[0-9a-f]{24,}"),
)
MORE = (
    Rule("key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", rb"gh[opsu]_([A-Za-z0-9]+)", 36),
)


class Nfa:
    """States with edges over byte sets and empty edges, built from a parsed pattern."""

    def __init__(self) -> None:
        self.states = 0
        self.edges: list[tuple[int, frozenset[int], int]] = []
        self.empty: list[tuple[int, int]] = []

    def state(self) -> int:
        self.states += 1
        return self.states - 1

    def add(self, items: Iterable, start: int, ignore_case: bool = False) -> int:
        """Append a sequence of parsed items after a state; returns the state where it ends."""
        for op, arg in items:
            end = self.state()
            if op in (ops.LITERAL, ops.NOT_LITERAL, ops.IN, ops.ANY):
                self.edges.append((start, _byte_set(op, arg, ignore_case), end))
            elif op is ops.SUBPATTERN:
                _, on, _, inner = arg
                self.empty.append((self.add(inner, start, ignore_case or bool(on & re.IGNORECASE)), end))
            elif op is ops.BRANCH:
                for choice in arg[1]:
                    self.empty.append((self.add(choice, start, ignore_case), end))
            elif op is ops.MAX_REPEAT:
                least, most, inner = arg
                at = start
                for _ in range(least):
                    at = self.add(inner, at, ignore_case)
                if most is ops.MAXREPEAT:
                    loop = self.state()
                    self.empty += [(at, loop), (self.add(inner, loop, ignore_case), loop), (loop, end)]
                else:
                    for _ in range(most - least):
                        self.empty.append((at, end))
                        at = self.add(inner, at, ignore_case)
                    self.empty.append((at, end))
            else:
                raise ValueError(f"{op} can't be compiled into the automaton")
            start = end
        return start


def _byte_set(op, arg, ignore_case: bool) -> frozenset[int]:
    if op is ops.LITERAL:
        found = {arg}
    elif op is ops.NOT_LITERAL:
        found = set(range(256)) - {arg}
    elif op is ops.ANY:
        found = set(range(256)) - {10}
    else:
        found, negated = set(), False
        for kind, value in arg:
            if kind is ops.NEGATE:
                negated = True
            elif kind is ops.LITERAL:
                found.add(value)
            elif kind is ops.RANGE:
                found |= set(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"{kind} can't be compiled into the automaton")
        found = set(range(256)) - found if negated else found
    if ignore_case:
        found |= {ord(chr(b).swapcase()) for b in found if b < 128 and chr(b).isalpha()}
    return frozenset(found)


class Dfa:
    """Transition arrays: ``table[state, class_of[byte]]``, state 0 first; ``accepts`` has a bit for each rule."""

    def __init__(self, edges, empty, starts: Sequence[int], finals: dict[int, int], unanchored: bool) -> None:
        sets = sorted({s for _, s, _ in edges}, key=sorted)
        marks = [tuple(b in s for s in sets) for b in range(256)]
        kinds = {m: i for i, m in enumerate(dict.fromkeys(marks))}
        self.class_of = bytes(kinds[m] for m in marks)
        sample = {c: b for b, c in enumerate(self.class_of)}
        steps, skips = defaultdict(list), defaultdict(list)
        for a, s, b in edges:
            steps[a] += [(c, b) for c in kinds.values() if sample[c] in s]
        for a, b in empty:
            skips[a].append(b)

        def closed(states: Iterable[int]) -> frozenset[int]:
            seen, todo = set(states), list(states)
            while todo:
                for b in skips[todo.pop()]:
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
            return frozenset(seen)

        # Subset construction.
        first = closed(starts)
        number, todo, table = {first: 0}, [first], []
        for current in todo:
            reached = defaultdict(set)
            for a in current:
                for c, b in steps[a]:
                    reached[c].add(b)
            row = []
            for c in range(len(kinds)):
                target = closed(reached[c] | set(starts) if unanchored else reached[c])
                if target not in number:
                    number[target] = len(todo)
                    todo.append(target)
                row.append(number[target])
            table.append(row)
        accepts = [sum({finals[a] for a in s if a in finals}) for s in todo]
        self.subsets = len(todo)

        # Minimisation: blocks are split until all states of one go to the same blocks.
        table, block = np.array(table), np.unique(accepts, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack((block, block[table])), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        order = np.full(block.max() + 1, -1)
        seen = [block[0], *[b for b in dict.fromkeys(block.tolist()) if b != block[0]]]
        order[seen] = np.arange(len(seen))
        member = np.array([np.flatnonzero(block == b)[0] for b in seen])
        self.table = order[block[table[member]]]
        self.accepts = np.array(accepts)[member]

    def rows(self) -> list[list]:
        """The arrays as linked rows: ``row[byte class]`` is the next row, ``row[-1]`` what it accepts."""
        rows: list[list] = [[] for _ in self.table]
        for row, targets, accepts in zip(rows, self.table.tolist(), self.accepts.tolist()):
            row += [rows[t] for t in targets] + [accepts]
        return rows


class Scanner:
    """All rules in one forward automaton that finds where matches end, and one backward automaton for each
    rule that finds where they begin. Only the few ends are ever read backward."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules = rules
        nfa, starts, finals, self.backward = Nfa(), [], {}, []
        for k, rule in enumerate(rules):
            first, edges, empty = nfa.state(), len(nfa.edges), len(nfa.empty)
            starts.append(first)
            last = nfa.add(_parser.parse(rule.pattern), first)
            finals[last] = 1 << k
            turned = Dfa(
                [(b, s, a) for a, s, b in nfa.edges[edges:]],
                [(b, a) for a, b in nfa.empty[empty:]],
                [last], {first: 1}, unanchored=False,
            )
            self.backward.append((turned.class_of, turned.rows()))
        self.forward = Dfa(nfa.edges, nfa.empty, starts, finals, unanchored=True)
        self.start = self.forward.rows()[0]
        self.values = [re.compile(r.pattern) for r in rules]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """Where some rule has matched and can't go on: (byte offset, bits of the rules)."""
        row, held, found, mark = self.start, 0, [], len(self.start) - 1
        for i, c in enumerate(data.translate(self.forward.class_of)):
            row = row[c]
            if row[mark] != held:
                gone = held & ~row[mark]
                if gone:
                    found.append((i, gone))
                held = row[mark]
        if held:
            found.append((len(data), held))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """Leftmost matches that don't overlap, for each rule on its own: (start, rule, end) in bytes, sorted."""
        found, free = [], [0] * len(self.rules)
        for end, bits in self.ends(data):
            for k, rule in enumerate(self.rules):
                if not bits >> k & 1:
                    continue
                classes, rows = self.backward[k]
                row, start = rows[0], -1
                for i in range(end - 1, free[k] - 1, -1):
                    row = row[classes[data[i]]]
                    if row[-1]:
                        start = i
                    elif all(r is row for r in row[:-1]):
                        break  # nothing before can match
                if start < 0:
                    continue
                free[k] = end
                if rule.least and len(self.values[k].fullmatch(data, start, end)[self.values[k].groups]) < rule.least:
                    continue
                found.append((start, k, end))
        return sorted(found)


@lru_cache(4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def spans_of(text: str | None, rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """Kind, start and end of each secret in code points, by start, then in the order of the rules."""
    if not text:
        return []
    data = text.encode("utf-8", "replace")
    found = scanner(rules).spans(data)
    if len(data) == len(text):
        return [(rules[k].kind, a, b) for a, k, b in found]
    return [(rules[k].kind, at := len(data[:a].decode()), at + len(data[a:b].decode())) for a, k, b in found]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, text: str = "text", spans: str = "spans", masked: str | None = None, mask: str = "[secret]", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Add the secrets of every whole text: an array of kind, start and end, in code points, the end exclusive.

    Matches of a rule are leftmost and don't overlap; those of different rules may. ``masked`` names a column
    for the text with every secret replaced by ``mask``. A null or empty text has no secrets and stays as it is;
    other columns stay, one that has the name of a result is replaced.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    place = f"c{docs.columns.index(text)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_bytes(batches, place, 4 << 20):
            texts = table.column(place).to_pylist()
            found = [spans_of(t, rules) for t in texts]
            table = table.append_column("s", pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in found], _SPANS))
            if masked:
                table = table.append_column("m", pa.array([t if not s else _masked(t, s, mask) for t, s in zip(texts, found)], pa.string()))
            yield from table.combine_chunks().to_batches()

    schema = ", ".join(f"{n} {t}" for n, t in kept.dtypes) + ", s array<struct<kind:string,start:bigint,end:bigint>>"
    done = kept.mapInArrow(run, schema + (", m string" if masked else ""))
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in (spans, masked)]
    return done.select(*named, F.col("s").alias(spans), *([F.col("m").alias(masked)] if masked else []))


def _masked(text: str, found: Sequence[tuple[str, int, int]], mask: str) -> str:
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


@query
def op10_automaton_secrets(spark, sf):
    """Secrets of all documents: counts by kind, a digest of the base kinds, and all spans."""
    found = find_secrets(documents(spark, sf).select("doc_id", "text")).drop("text")

    def listed(kinds: tuple[str, ...] | None):
        some = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
        parts = F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = tuple(r.kind for r in BASE)
    return found.select(
        "doc_id", *map(number, base), F.sha2(listed(base), 256).alias("base_sha256"), listed(None).alias("spans")
    )
