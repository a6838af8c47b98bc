"""Personal data and what gives it away, against plain Python."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
import regex as re
from brute import LONG, SF, empty, odd, shipped  # noqa: F401
from pyspark.sql import functions as F

from adjudica.llm import disclosure
from adjudica.llm.queries import QUERIES

pytestmark = pytest.mark.usefixtures("shipped")
KINDS = ["email", "ip", "card", "phone"]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SCHEMA = "doc_id long, text string, row string, hits string, term string, terms string, entity string, lang string"


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for order, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                value = m[0].lower() if kind == "email" else m[0] if kind == "ip" else d
                out.append((m.start(), order, m.end(), f"{kind}:{value}"))
    return sorted(out)


def near(text, hits):
    for start, _, end, entity in hits:
        for lo, hi in ((max(start - 64, 0), start), (end, min(end + 64, len(text)))):
            for m in re.finditer(r"[\p{L}\p{N}_]+", text[lo:hi]):
                a, b = m.start() + lo, m.end() + lo
                cut = (hi == start and (b == hi or (a == lo and lo > 0))) or (lo == end and (a == lo or (b == hi and hi < len(text))))
                if not cut and b - a >= 3 and not any(s <= b and a <= e for s, _, e, _ in hits):
                    yield entity, m[0].lower(), a, b


def brute(texts, least_texts=2, generalise=0.75):
    n = len(texts)
    hits = [base(t) for t in texts]
    words = [list(near(t, h)) for t, h in zip(texts, hits)]
    with_term = Counter(w for t in texts for w in set(re.findall(r"[\p{L}\p{N}_]+", t.lower())))
    with_entity = Counter(e for h in hits for e in {x[3] for x in h})
    both, seen = Counter(), defaultdict(set)
    for text, found in zip(texts, words):
        for pair in {(e, w) for e, w, _, _ in found}:
            both[pair] += 1
            seen[pair].add(text)
    strong = set()
    for (e, w), k in both.items():
        if len(seen[e, w]) >= least_texts and with_entity[e] < n:
            share = math.log2(n * k / (with_term[w] * with_entity[e])) / math.log2(n / with_entity[e])
            if round(share, 9) >= generalise:
                strong.add((e, w))
    out = []
    for h, found in zip(hits, words):
        terms = {(a, 4, b) for e, w, a, b in found if (e, w) in strong}
        out.append((h, sorted([x[:3] for x in h] + list(terms))))
    return out


def written(spans):
    return ",".join(f"{[*KINDS, 'term'][k]}:{a}:{b}" for a, k, b in spans)


ODD_TEXTS = [
    None, "", "no data", "a@b.c_d@e.f x@y.z.w, u@v", "@a.b a@ a@b a@b..c .@-.- a.b@c.d.", "é漢🙂 me@x.org 🙂 you@x.org", "1.2.3.4.5.6.7.8 256.1.1.1 0.0.0.0 000255.1.1.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 41111111111111114111111111111111", "+1 (555) 123-4567 +12 +123 +1234567890123456 ++49 170 1234567- x", "7" * 4000 + ".1.1.1",
    "a" * 9000, "a." * 4000 + "@", "1 " * 5000, "@" * 1000, "9" * 9000, "x@y.z " * 3000, "me\ue000you a@b.org \ue000 word", ". " * 10 + "+" * 500 + "1-" * 2000, LONG + " k@l.mn",
]


def frame_of(frame, texts):
    return frame(SCHEMA, *[(i if i % 5 else None, t, *["x"] * 6) for i, t in enumerate(texts)])


def spans_of(df):
    rows = df.select("doc_id", "text_key", "hits", "terms").collect()
    return [([(h.start, h.kind, h.end, h.entity) for h in r.hits], sorted([(h.start, h.kind, h.end) for h in r.hits] + [(t.start, 4, t.end) for t in r.terms])) for r in rows]


def test_odd_texts(frame, odd):
    found = spans_of(disclosure.disclosures(frame_of(frame, ODD_TEXTS)))
    assert sorted(found) == sorted(brute([t or "" for t in ODD_TEXTS]))
    assert disclosure.disclosures(odd).count() == 14 and disclosure.disclosures(empty(odd)).count() == 0
    assert disclosure.sanitised(odd).columns == odd.columns and disclosure.sanitised(empty(odd)).count() == 0


def test_long_unbroken_texts_take_linear_time(frame):
    texts = ["a" * 2_000_000, "a." * 500_000 + "@", "1 " * 500_000, "9" * 1_000_000, "9" * 1_000_000 + ".1.1", "a@" * 500_000, "+1" + "-" * 1_000_000]
    assert all(found == ([], []) for found in spans_of(disclosure.disclosures(frame_of(frame, texts))))


def test_random_texts(frame):
    rng = random.Random(5)
    alphabet = ["a", "Z", "0", "12", "255", ".", "@", "-", "+", " ", "(", ")", "_", "é", "4111111111111111", "%"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    assert sorted(spans_of(disclosure.disclosures(frame_of(frame, texts)))) == sorted(brute(texts))


def corpus():
    people = {"ann@x.org": "Annabel Vane", "+49 170 123 45 67": "Robert", "4111 1111 1111 1111": "zebra2"}
    filler = [f"the plan of day {i} was kept by many and the {w} went on" for i, w in enumerate(["boat", "train", "horse"] * 40)]
    return filler + [f"{name} wrote on day {i}: {value} is the way to the plan" for value, name in people.items() for i in range(4)] + ["Annabel Vane ann@x.org"] * 3


def test_words_that_stand_near_one_entity_only_are_found(frame):
    texts = corpus()
    df = frame_of(frame, texts)
    assert sorted(spans_of(disclosure.disclosures(df))) == sorted(brute(texts))
    cleaned = {r.text for r in disclosure.sanitised(df.withColumn("doc_id", F.monotonically_increasing_id())).collect()}
    assert not any(x in t for t in cleaned for x in ("Annabel", "Vane", "ann@x.org", "Robert", "zebra2", "4111", "+49"))
    assert sum(t in cleaned for t in texts) == 120 and any("[EMAIL] is the way to the plan" in t for t in cleaned)
    mild = {r.text for r in disclosure.sanitised(df, remove=2.0).collect()}
    assert any(t.startswith("[NAME] [NAME]") for t in mild) and any("[WORD]" in t for t in mild)


def test_one_entity_in_a_third_of_all_rows(frame):
    texts = [f"call hotline +1 800 555 0100 now {i}" if i % 3 == 0 else f"text number {i} of many" for i in range(600)]
    found = spans_of(disclosure.disclosures(frame_of(frame, texts)))
    assert sorted(found) == sorted(brute(texts)) and sum(len(s) > 1 for _, s in found) == 200


def test_running_sums(frame):
    lists = [[], [5], list(range(255)), list(range(256)), list(range(257)), [3] * 5000]
    rows = frame("a array<long>", *[(x,) for x in lists]).select("a", disclosure.running_sums(F.col("a")).alias("s")).collect()
    for r in rows:
        total, want = 0, []
        for x in r.a:
            total += x
            want.append(total)
        assert r.s == want


def test_all_documents_and_no_python(spark):
    found = {r.doc_id: r for r in QUERIES["op13_information_theoretic_sanitisation"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(texts, brute(list(texts.values()))))
    assert found.keys() == texts.keys()
    for i, (hits, spans) in want.items():
        r, plain = found[i], [h[:3] for h in hits]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, x, _ in plain) for k in range(4)]
        assert (r.base_sha256, r.spans) == (hashlib.sha256(written(plain).encode()).hexdigest(), written(spans))
    plan = QUERIES["op13_information_theoretic_sanitisation"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def near_in_whole_texts(text, hits):
    for m in re.finditer(r"[\p{L}\p{N}_]+", text):
        if len(m[0]) >= 3 and not any(s <= m.end() and m.start() <= e for s, _, e, _ in hits):
            for entity in {x[3] for x in hits}:
                yield entity, m[0].lower(), *m.span()


def brute_of_whole_texts(texts, **settings):
    with pytest.MonkeyPatch.context() as patched:
        patched.setitem(globals(), "near", near_in_whole_texts)
        return brute(texts, **settings)


def far_corpus():
    """Names that stand far from the data they belong to, on either side, in copies and in texts with several entities."""
    gap = " ".join(["and so the plan went on"] * 8)
    texts = [f"{w} was kept on day {i} {gap}" for i, w in enumerate(["boat", "train", "horse"] * 30)]
    texts += [f"Annabel came. {gap} ann@x.org {i} {gap} Vane and +49 170 123 45 67" for i in range(4)] + [f"{gap} ann@x.org {gap} Annabel"] * 3
    return texts + [f"Robert {gap} boat {i} {gap} +49 170 123 45 67 or 4111 1111 1111 1111 train" for i in range(3)] + [f"zebra {gap} once@x.org"] + [None, "", "me@x.org"]


def test_words_far_from_an_entity_are_weighed(spark, frame, tmp_path):
    texts = far_corpus()
    df = frame_of(frame, texts)
    want = brute_of_whole_texts([t or "" for t in texts])
    assert sorted(spans_of(disclosure.disclosures(df, window=None))) == sorted(want)
    df.withColumn("doc_id", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op13_information_theoretic_sanitisation"](spark, str(tmp_path)).collect()
    assert sorted(r.spans for r in found) == sorted(written(spans) for _, spans in want)
    cleaned = {r.text for r in disclosure.sanitised(df.withColumn("doc_id", F.monotonically_increasing_id()), window=None).collect()}
    assert not any(x in (t or "") for t in cleaned for x in ("Annabel", "Vane", "Robert", "ann@x.org")) and any("zebra" in (t or "") for t in cleaned)


def test_random_whole_texts(frame):
    rng = random.Random(7)
    alphabet = ["a", "Z", "0", "12", "255", ".", "@", "-", "+", " ", " ", "(", "_", "é", "4111111111111111", "MICE", "dog"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(300)]
    texts += texts[:60] + [" ".join(rng.choice(["ann@x.org", "bob@x.org", "10.0.0.1", *(f"w{i}" + "x" * (i % 3) for i in range(90))]) for _ in range(60)) for _ in range(80)]
    for settings in ({}, {"generalise": 0.3}, {"generalise": -1.0, "least_texts": 3}):
        found = spans_of(disclosure.disclosures(frame_of(frame, texts), window=None, **settings))
        want = brute_of_whole_texts(texts, **settings)
        assert sorted(found) == sorted(want) and sum(len(spans) > len(hits) for hits, spans in want) > 20
    assert disclosure.disclosures(frame_of(frame, texts[:3]), window=None).count() == 3
    assert disclosure.disclosures(empty(frame_of(frame, texts)), window=None).count() == 0
