"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import LONG, empty, odd, shipped  # noqa: F401

from adjudica.llm import collocations as c

pytestmark = pytest.mark.usefixtures("shipped")
SCHEMA = "doc_id long, text string, lang string, n string, phrase string, slice string, next string, words string"


def plain(rows, least, top, subsumed=100, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    gone = set()
    for (lang, p), v in cand.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                if 100 * v >= subsumed * f[lang, p[i : i + size]]:
                    gone.add((lang, p[i : i + size]))
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1)}


def check(frame, rows, least, top=2000, subsumed=100):
    docs = frame(SCHEMA, *[(i, t, lang, *["x"] * 5) for i, (t, lang) in enumerate(rows)])
    found = c.collocations(docs, least=least, top=top, subsumed=subsumed)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in found.collect()]
    assert len(set(got)) == len(got) and set(got) == plain(rows, least, top, subsumed)
    return got


def test_random_texts(frame, monkeypatch):
    monkeypatch.setattr(c, "BATCH_BYTES", 2000)  # so that stripes of several batches meet
    rng = random.Random(3)
    words = ["a", "A", "the", "of", "é", "漢", "don't", "x\x85y", "\xa0"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ","]) for _ in range(60)), rng.choice(["en", "fr", None, "und", ""])) for _ in range(200)]
    assert check(frame, rows, 8)
    check(frame, rows, 8, top=7)
    monkeypatch.setattr(c, "HOT_SHARE", 0.05)  # some prefixes have slices, some have not
    check(frame, rows, 5, subsumed=80)


def test_one_sentence_in_a_third_of_all_rows(frame):
    rows = [("to be or not to be that is the question", "en")] * 150 + [(f"to be w{i % 50} z{i}", "en") for i in range(300)]
    got = check(frame, rows, 100)
    assert "to be" in {r[2] for r in got} and "or not" not in {r[2] for r in got}


def test_nulls_empty_long_and_repeated_rows(frame, odd):
    rows = [(None, None), ("", "en"), (" \n\t.,", "en"), (LONG, "en"), (LONG, "en"), ("Ab ab", None), ("ab AB.", "und"), ("ab ab", None)]
    assert check(frame, rows, 3)
    assert c.collocations(odd, least=3).count() > 0
    assert c.collocations(empty(odd)).count() == 0 and c.collocations(frame(SCHEMA, (1, "a b", "en", *["x"] * 5))).count() == 0


def test_scores_pass_64_bits(frame):
    rows = [("p", 4 * 10**15, 9 * 10**17, [5 * 10**15, 4 * 10**15 + 3], [8 * 10**15 + 1, 10**16])]
    found = c.scored(frame("phrase string, f long, words long, lefts array<long>, rights array<long>", *rows)).first()
    a, n, lefts, rights = rows[0][1:]
    want = min((1000 * a * n // (x * y), i) for i, (x, y) in enumerate(zip(lefts, rights)))
    assert (found.score, found.l, found.r) == (want[0], lefts[want[1]], rights[want[1]])


def test_the_filter_lets_all_its_phrases_pass(frame):
    phrases = [("en" if i % 2 else "", f"w{i} é{i % 7}") for i in range(3000)]
    bits = c.phrase_filter(frame("lang string, phrase string", *phrases))
    words = c.Words(pa.table({"lang": [x for x, _ in phrases], "text": [p for _, p in phrases]}))
    hashes, at = words.hashes(), np.arange(0, 6000, 2)
    for other, share in ((0, 1.0), (1, 0.01)):
        key = c._keys(words, hashes + np.uint64(other), at, 2)
        passed = c._passes(key, bits).mean()
        assert passed == 1 if share == 1 else passed < share
    assert (c.phrase_keys(phrases) == np.sort(c._keys(words, hashes, at, 2))).all()


def test_a_batch_has_no_more_rows_than_parts(monkeypatch):
    monkeypatch.setattr(c, "PARTS", 500)
    rng = random.Random(4)
    texts = [(rng.choice(["en", "fr"]), " ".join(f"w{rng.randrange(3000)}" for _ in range(400))) for _ in range(50)]
    words = c.Words(pa.table({"lang": [x for x, _ in texts], "text": [t for _, t in texts]}))
    at = np.flatnonzero(words.piece[:-1] == words.piece[1:])
    hot = c.phrase_keys([("en", "w1"), ("fr", "w2")])
    rows = [r for batch in c._stripes_of(words, at, 2, hot) for r in batch.to_pylist()]
    got, parts = Counter(), {}
    for r in rows:
        for x, n, i in zip(r["next"].split(" "), r["n"], r["stripe"], strict=True):
            got[r["langs"][i], r["prefixes"][i], x] += n
            parts.setdefault((r["langs"][i], r["prefixes"][i]), set()).add(r["part"])
    want = Counter((lang, x, y) for lang, t in texts for x, y in zip(t.split(), t.split()[1:]))
    assert got == want and len({r["part"] for r in rows}) == len(rows) <= 500 < len(parts)
    assert {k for k, v in parts.items() if len(v) > 1} <= {("en", "w1"), ("fr", "w2")}
