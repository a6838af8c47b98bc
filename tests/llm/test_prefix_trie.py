"""The prefix trie of conversations against a plain walk through the tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from brute import empty, shipped  # noqa: F401

from adjudica.llm.prefix_trie import prefix_trie

pytestmark = pytest.mark.usefixtures("shipped")
SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, last string, _place string"


def plain(rows):
    """Node by node, with the places of the arcs from a depth-first walk."""
    said = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            ident = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, ident, role, text))
    said = {c: [x[3:] for x in sorted(v)] for c, v in said.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(said.get(c - c % 5, [])[:h]) + tuple(own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, clock = {}, 0

    def weight(node):
        return (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0

    stack, entered, sums = [((), False)] if members else [], {}, {}
    while stack:
        node, done = stack.pop()
        if not done:
            entered[node], clock = clock, clock + 1
            stack.append((node, True))
            own = min(members[node])
            kids = sorted(children[node], key=lambda k: (min(members[k]) != own, min(members[k])))
            stack += [(k, False) for k in reversed(kids)]
            continue
        kids = children[node]
        sums[node] = (sum(sums[k][0] for k in kids) or 1, sum(sums[k][1] for k in kids) + weight(node))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(rebuilt[c]) == len(node))))
        out[min(members[node]), len(node)] = (
            min(members[node[:-1]]) if node else None, len(members[node]), len(kids), *sums[node], hashlib.sha256(ends.encode()).hexdigest(), entered[node], clock,
        )
        clock += 1
    return out


def found(df):
    rows = prefix_trie(df).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256, r.enter_at, r.exit_at) for r in rows}
    assert len(got) == len(rows)
    return got


def wide(rows):
    return [(*r, "x", "x", "x", "x") for r in rows]


def test_random_conversations_with_shared_turns(frame):
    rng = random.Random(7)
    rows = [(c, t, rng.choice("ua"), rng.choice(["é", "yes", "no no", ""])) for c in range(60) for t in range(rng.randrange(14))]
    rows += [(c, t, "u", f"same {t}") for c in range(100, 140) for t in range(12)]  # a group of copies
    rng.shuffle(rows)
    assert found(frame(SCHEMA, *wide(rows))) == plain(rows)


def test_nulls_ties_repeated_rows_and_missing_donors(frame):
    rows = [
        (None, 1, "u", "of no conversation"), (3, None, "u", "first"), (3, 0, None, None), (3, 0, None, None), (3, 0, "b", "tie"), (3, 0, "a", "tie"),
        (7, 1, "u", "x"), (8, 1, "u", "x"), (5, 2, "u", "x"), (5, 1, None, "y" * 70_000), (9, 5, "ab", "c"), (11, 5, "a", "bc"), (6, 1, "u", "only"),
    ]
    assert found(frame(SCHEMA, *wide(rows))) == plain(rows)


def test_a_conversation_with_most_rows_spans_many_groups(frame, monkeypatch):
    monkeypatch.setattr("adjudica.llm.prefix_trie.BLOCK", 16)
    monkeypatch.setattr("adjudica.llm.prefix_trie.CHUNK", 8)
    rows = [(10, t, "u", f"t{t % 3}") for t in range(400)] + [(c, t, "u", f"t{t % 3}") for c in range(11, 31) for t in range(c)]
    assert found(frame(SCHEMA, *wide(rows))) == plain(rows)


def test_no_conversations(frame):
    assert prefix_trie(empty(frame(SCHEMA, *wide([(1, 1, "u", "x")])))).count() == 0
