"""The operators against brute force: over the smallest given tables, and over tables of odd cases."""

import random
import re
import string
import unicodedata
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from brute import (
    CLASHES, LIBRARY, LONG, ODD, PROSE, SECRET, SF, check_packing, documents, empty, groups, ids, odd, secrets as brute_secrets, sha, shingles, shipped, without_repeats,
)  # noqa: F401
from hypothesis import given, settings, strategies as st

from adjudica.llm import bpe, kdtree, language, minhash, packing, secrets, sharding, substrings, token_counts, vocabulary, winnowing
from adjudica.llm.queries import ORACLE, QUERIES

pytestmark = pytest.mark.usefixtures("shipped")
given_tables = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")
VOCABULARY = vocabulary.loaded(Path(vocabulary.DEFAULT).read_bytes())


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


# 1 sharding


def sound_shards(found, shards=16, slack=0.01):
    sizes = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max((r.size for r in found), default=0)
    target = sum(sizes) / shards
    assert all(abs(s - target) <= largest + 2 * slack * target for s in sizes)


@given_tables
def test_shards_of_all_documents(spark):
    found = QUERIES["op1_prefix_sum_shards"](spark, SF).collect()
    texts = documents(spark)
    assert {r.doc_id for r in found} == set(texts) and {r.law for r in found} == {"bytes"}
    for r in found:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(data) + 1, zlib.crc32(data), None)
    sound_shards(found)


def test_shards_keep_small_groups_whole_and_split_large_ones(frame, odd):
    many = frame("doc_id long, text string", *[(i, "hot" if i % 3 == 0 else f"pair {i // 2}") for i in range(900)])
    found = sharding.shard_by_bytes(many, shards=4, slack=0.05).collect()
    sound_shards(found, 4, 0.05)
    owners = {}
    for r in found:
        owners.setdefault(r.group_id, set()).add(r.shard)
    assert sorted(map(len, owners.values()))[-1] >= 2 and sorted(map(len, owners.values()))[-2] == 1
    assert sharding.shard_by_bytes(odd).count() == 14 and sharding.shard_by_bytes(empty(odd)).count() == 0


def test_cuts_of_large_tables_are_exact(frame):
    totals = [5 * 10**8, 3 * 10**10, 10**12, 10**17]
    sums = [(t - left, t) for t in totals for left in (*range(1, 901), 20_000)]
    sums += [(t * i // 16 + d, t) for t in totals for i in range(1, 16) for d in (-400, -1, 0, 1)]
    df = frame("before long, total long", *sums)
    found = df.select("before", "total", sharding.cut_of(df.before, df.total, 16).alias("cut")).collect()
    assert len(found) == len(sums) and all(r.cut == r.before * 16 // r.total <= 15 for r in found)


# 2 and 5 tokens


@given_tables
def test_tokens_of_all_documents(spark):
    texts = documents(spark)
    counts = {r.doc_id: r for r in QUERIES["op5_heap_token_counts"](spark, SF).collect()}
    coded = QUERIES["op2_pair_index_bpe"](spark, SF).collect()
    assert len(coded) == len(counts) == len(texts)
    for r in coded:
        want = ids(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(want), sha(",".join(map(str, want))))
        assert r.decoded_sha256 == sha(LIBRARY.decode(want, skip_special_tokens=False))
        c = counts[r.doc_id]
        assert (c.n_bytes, c.n_tokens, c.over_limit) == (len(texts[r.doc_id].encode()), len(want), len(want) > 512)


def test_tokens_of_odd_texts(odd):
    coded = bpe.encode(odd.withColumn("copy", odd.text), decoded="again")
    assert set(coded.columns) == {*odd.columns, "copy", "again"} - {"text"}
    for r in bpe.decode(coded).collect():
        assert r.ids == ids(r.copy) and r.decoded == r.again == (r.copy or "")
    for r in token_counts.count_tokens(odd).collect():
        assert r.n_tokens == len(ids(r.text)) and r.rank == "x"
    assert bpe.encode(empty(odd)).count() == 0 and token_counts.count_tokens(empty(odd)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aab  \n'stERl12.,"), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_all_encoders_agree_with_the_library(texts):
    index = bpe.PairIndex(VOCABULARY)
    coder = vocabulary.Coder(VOCABULARY, lambda p: [x.tolist() for x in index.encode(p)], lambda v: sum(v, []), lambda i: [i])
    counter = vocabulary.Coder(VOCABULARY, lambda p: [token_counts.merged_count(x.encode(), VOCABULARY) for x in p], sum, lambda i: 1)
    packer = packing.Encoder(VOCABULARY.data)
    for _ in range(2):  # the second time words are remembered
        for text, a, b, c in zip(texts, coder.code(texts), counter.code(texts), packer.ids(texts)):
            want = ids(text)
            assert sum(a, []) == want and sum(b) == len(want) and np.frombuffer(c, np.uint32).tolist() == want


def test_every_character_is_cut_as_by_the_library():
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False)
    sure = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not vocabulary.UNSURE.search(chr(c))]
    assert len(sure) > 1000
    for c in sure:
        text = f"a{c}1 {c}{c} b"
        assert vocabulary.PIECES.findall(text) == [text[a:b] for _, (a, b) in cut.pre_tokenize_str(text)]


def test_whole_texts_with_long_runs_are_encoded_as_by_the_library():
    packer = packing.Encoder(VOCABULARY.data)
    for text in (" " * 1_200_000 + "x", "a" + "\n" * 5000, "x" + " " * 4095 + "y", "hi<|endoftext|> there", None, "a" * 20_000):
        assert np.frombuffer(packer.ids([text])[0], np.uint32).tolist() == ids(text)


def test_long_runs_of_one_symbol_are_merged_as_by_the_library():
    for text in ("a" * 5001, "ab" * 3000, " " * 777 + "x", "=" * 1000):
        pieces = VOCABULARY.pieces(text)
        got = np.concatenate(bpe.PairIndex(VOCABULARY).encode(pieces)).tolist()
        assert got == ids(text) and sum(token_counts.merged_count(p.encode(), VOCABULARY) for p in pieces) == len(got)


# 3 near-duplicates


def same_groups(found, rows, n, hundredths):
    tops = groups([t for _, t in rows], n, hundredths)
    least = {}
    for (i, _), top in zip(rows, tops):
        least[top] = min((x for x in (i, least.get(top)) if x is not None), default=None)
    want = sorted(((i, len(shingles(t, n)), least[top]) for (i, t), top in zip(rows, tops)), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == want
    assert all(r.kept == (r.component_id is None or r.doc_id == r.component_id) for r in found if r.doc_id is not None)


@given_tables
def test_near_copies_of_all_documents(spark):
    found = QUERIES["op3_circulant_minhash"](spark, SF).collect()
    same_groups(found, list(documents(spark).items()), 3, 85)


def test_near_copies_of_odd_texts_and_large_groups(spark, frame, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same_groups(minhash.near_duplicates(odd).collect(), rows, 5, 80)
    assert minhash.near_duplicates(empty(odd)).count() == 0
    # A chain: neighbours are alike, its ends aren't; and a group around one text whose members are barely alike.
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[i : i + 120]) for i in range(0, 160, 8)]
    base = words[:100]
    star = [" ".join([*base[:k], "odd" + str(k), *base[k + 1 :]]) for k in rng.sample(range(100), 40)]
    rows = list(enumerate([*chain, *star, *chain[:5]]))
    same_groups(minhash.near_duplicates(frame("doc_id long, text string", *rows)).collect(), rows, 5, 80)


def test_groups_just_below_the_threshold_and_repeated_rows(frame):
    rng = random.Random(6)
    texts = []
    for family in range(4):  # members of one family change 0 to 4 words of one text, so some are linked and some aren't
        base = [f"f{family}w{i}" for i in range(90)]
        for i in range(30):
            words = list(base)
            for at in rng.sample(range(90), rng.randrange(5)):
                words[at] = rng.choice(["x", "y", f"own{family}-{i}"])
            texts.append(" ".join(words[rng.randrange(9) :]))
    rows = [*enumerate(texts), *[(7, texts[7])] * 50, *[(None, texts[8])] * 50]
    for n, hundredths in ((3, 85), (5, 80)):
        found = minhash.near_duplicates(frame("doc_id long, text string", *rows), words=n, similarity=hundredths / 100).collect()
        same_groups(found, rows, n, hundredths)


def test_members_of_a_bucket_below_the_threshold_make_few_pairs(spark, frame, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(120):  # about 0.6 alike; what one has in place of a word, others have too
        out = set(rng.sample(range(300), 12))
        rows.append((i, " ".join(f"{'x' if j in out else 'w'}{j}" for j in range(300))))
    compared, confirm = spark.sparkContext.accumulator(0), minhash._confirm

    def counted(similarity):
        def run(batches, inner=confirm(similarity)):
            def each():
                for batch in batches:
                    compared.add(batch.num_rows)
                    yield batch

            return inner(each())

        return run

    monkeypatch.setattr(minhash, "_confirm", counted)
    found = minhash.near_duplicates(frame("doc_id long, text string", *rows, (120, rows[7][1] + " more")), words=3, similarity=0.85).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i for i in range(120)} | {120: 7}
    assert 0 < compared.value < 120


def test_parities_differ_in_no_more_bits_than_sets_do():
    rng = np.random.default_rng(2)
    for n, m in ((0, 1), (3, 3), (200, 20), (900, 30), (5000, 4000)):
        both, one, other = (rng.integers(0, 1 << 64, k, np.uint64) for k in (n, m, m // 2))
        x, y = minhash.parities(np.concatenate([both, one])), minhash.parities(np.concatenate([other, both]))
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= m + m // 2 and (m > 30 or differ > 0.8 * (m + m // 2))


def test_bands_miss_few_pairs_at_the_threshold():
    for similarity in (0.8, 0.85, 0.95):
        bands = minhash.bands_for(similarity, 1e-6)
        assert (1 - similarity**minhash.ROWS_PER_BAND) ** bands <= 1e-6


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    shared, a, b = (np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (600, 200, 200))
    left, right = np.sort(np.concatenate((shared, a))), np.sort(np.concatenate((shared, b)))
    x, y = minhash.signatures([left, right], 1000)
    assert abs((x == y).mean() - 0.6) < 0.06


# 4 repeats


@given_tables
def test_repeats_of_all_documents(spark):
    texts = documents(spark)
    found = {r.doc_id: r for r in QUERIES["op4_block_anchor_repeats"](spark, SF).collect()}
    order = sorted(texts)
    for i, (words, gone) in zip(order, without_repeats([texts[i] for i in order])):
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(words), sum(gone), sha(kept))


def test_repeats_of_odd_texts_and_shifted_passages(frame, odd):
    rng = random.Random(11)
    words = [f"v{rng.randrange(50)}" for _ in range(4000)]
    texts = [" ".join(words[a : a + rng.randrange(15, 60)]) for a in (rng.randrange(3900) for _ in range(120))]
    texts += ["a " * 70, " ".join(words[:19]), " ".join(words[:20]), " ".join(words[:20])]
    for df in (frame("doc_id long, text string", *enumerate(texts)), odd):
        rows = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()), key=repr)
        want = [(i, len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode()) for (i, _), (w, g) in zip(rows, without_repeats([t for _, t in rows]))]
        assert got == sorted(want, key=repr)
    assert substrings.remove_repeats(empty(odd)).count() == 0
    untouched = [r for r in substrings.remove_repeats(odd, as_is=True).collect() if r.doc_id == 7]
    assert untouched[0].kept == ODD and untouched[0].label == "x"


def test_small_texts_make_no_more_chunks_than_partitions(frame, monkeypatch):
    asked, bounds = [], substrings.chunk_bounds
    monkeypatch.setattr(substrings, "chunk_bounds", lambda docs, key, chunks: asked.append(chunks) or bounds(docs, key, chunks))
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(60)]
    large = [(i, text * 6 * (substrings.LEAST_CHUNK_BYTES // len(text))) for i, text in rows[:4]]
    for docs in ([], [(1, None)], rows, large):
        substrings.remove_repeats(frame("doc_id long, text string", *docs))
    assert asked == [4, 4, 4, 16]


# 6 fingerprints


@given_tables
def test_fingerprints_of_all_documents(spark):
    texts = documents(spark)
    found = {r.doc_id: r for r in QUERIES["op6_winnowing_fingerprints"](spark, SF).collect()}
    order = sorted(texts, reverse=True)
    prints = {}
    for i, j in zip(order, [*order[1:], order[0]]):
        n = len(texts[i])
        edited = texts[i][: n - n // 3] + texts[j][: n // 3]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha(edited)) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(texts[i], r.fingerprint) == r.fingerprint
    longer = [r for r in found.values() if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in longer]) > 0.95


def minima(grams):
    """Places of the rightmost minimum of every window of 8, in order, each once."""
    windows = [range(i, min(i + 8, len(grams))) for i in range(max(len(grams) - 7, min(1, len(grams))))]
    return sorted({min(w, key=lambda p: (grams[p], -p)) for w in windows})


def test_fingerprints_are_the_rightmost_minima(spark, frame):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \n") for _ in range(n)) for n in (300, 40, 21, 19, 13, 12, 11)]
    texts += ["a" * 60, "\U0001f600" * 30 + "xyz", "One Two", "", "  ", "a", None]
    dense = ["".join((t or "").lower().split()) for t in texts]
    cut = [[d[i : i + 12] for i in range(max(len(d) - 11, min(1, len(d))))] for d in dense]
    grams = sorted({g for c in cut for g in c})
    hashed = frame("g string", *[(g,) for g in grams]).select("g", winnowing.F.xxhash64(winnowing.F.encode("g", "UTF-32")).alias("h"))
    value = {r.g: r.h & winnowing._LOW for r in hashed.collect()}
    found = winnowing.winnow(frame("k long, t string", *enumerate(texts)), "t", "f").collect()
    for r in found:
        want = [value[g] for g in cut[r.k]]
        assert [(v >> 32, winnowing._LOW - (v & winnowing._LOW)) for v in r.f] == [(want[p], p) for p in minima(want)]
    assert len(found) == len(texts)


def test_likeness_is_of_the_distinct_hashes(frame):
    texts = ["the quick brown fox jumps over the lazy dog and runs away", "a quick brown fox jumps over one lazy dog", "", ""]
    df = winnowing.winnow(frame("doc_id long, text string", *enumerate(texts)), "text", "f")
    sets = {r.doc_id: {v >> 32 for v in r.f} for r in df.collect()}
    found = {r.doc_id: r for r in winnowing.fingerprints(df.select("doc_id", "text")).collect()}
    for i in range(4):
        a, b = sets[i], sets[(i - 1) % 4]
        assert found[i].near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert {v >> 32 for v in found[i].fingerprint} == a


@given_tables
def test_every_kept_passage_is_met(spark):
    texts = documents(spark)
    found = QUERIES["op6_winnowing_fingerprints"](spark, SF).collect()
    kept = {i: len("".join(t[: len(t) - len(t) // 3].split())) for i, t in texts.items()}
    assert {r.doc_id for r in found if not r.near_edited} <= {i for i, n in kept.items() if n < 20}


def test_short_and_shifted_passages_are_met(frame):
    rng = random.Random(3)
    words = [" ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(5)) for _ in range(n)) for n in range(6, 29)]
    dense = ["".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n)) for n in (30, 90, 400)]
    found = winnowing.fingerprints(frame("doc_id long, text string", *enumerate(words + dense))).collect()
    assert len(found) == len(words + dense) and all(r.near_edited > 0 for r in found)
    # The same passage behind 0 to 20 characters, of text without blanks and of one with; the last is beyond the BMP.
    passages = [dense[0][:19], words[0].replace(" ", "")[:19], "\U00020000" * 9 + "\U00020001" * 10]
    rows = [("\u4e00\U0001f600x"[i % 3] * i + p + "z" * (20 - i), j) for j, p in enumerate(passages) for i in range(21)]
    df = frame("t string, k long", *rows)
    df = winnowing.winnow(df, "t", "f")
    for j in range(3):
        alike = [set(r.h) for r in df.where(df.k == j).select(winnowing.hashes(df.f).alias("h")).collect()]
        assert all(a & b for a in alike for b in alike)


def test_fingerprints_of_odd_texts(odd):
    found = winnowing.fingerprints(odd).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = [(i, t, t[: len(t) - len(t) // 3] + n[: len(t) // 3]) for (i, t), (_, n) in zip(rows, [*rows[1:], rows[0]])]
    assert sorted(((r.doc_id, r.text, r.edited) for r in found), key=repr) == sorted(want, key=repr)
    assert winnowing.fingerprints(empty(odd)).count() == 0


def test_fingerprints_stay_in_the_jvm(odd):
    plan = winnowing.fingerprints(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 7 language


@given_tables
def test_held_out_languages(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op7_bidirectional_gru_language"](spark, SF).collect()
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(unicodedata.category(c)[0] == "L" for c in truth[r.doc_id].text or ""))
    tried = [r for r in found if r.held_out and truth[r.doc_id].lang and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in tried]) > 0.95


def test_languages_of_odd_texts(odd):
    model = language.train(odd, rounds=20)
    assert model.labels == ["en", "fr"] and language.train(empty(odd)) is None
    found = language.identify(odd, model, predicted="guess", score="sure").collect()
    assert all(r.lang_pred == "x" and r.score == "x" for r in found)
    assert {r.doc_id for r in found if r.guess == "und"} == {3, 4, 5, 10}
    assert all(r.sure == 0 for r in found if r.guess == "und")
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


def test_rows_of_one_id_do_not_widen_the_sample(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "learn", lambda data, labels, *_: seen.append((len(data), len(labels))))
    rows = [(1, "x", f"some words number {i % 900}") for i in range(1800)] + [(2, "y", "others")]
    language.train(frame("doc_id long, lang string, text string", *rows), sample=25, spans=1)
    assert seen == [(26, 26)]


def test_signs_that_are_no_letters_have_no_language(frame):
    rng = np.random.default_rng(1)
    h, k = language.HIDDEN, 2
    sizes = ((2, 256, 2 * h), (2, 256, h), (2, h, 2 * h), (2, h, h), (2, h, k), (k,))
    model = language.Model(["a", "b"], *[rng.normal(0, 0.5, s).astype(np.float32) for s in sizes])
    found = language.identify(frame("text string", ("\u00bd \u00b2 \u2167",), ("\u00bd x",), ("\u6f22",)), model).collect()
    assert [r.lang_pred == "und" for r in found] == [True, False, False]


def test_long_texts_are_read_whole():
    rng = np.random.default_rng(0)
    h, k = language.HIDDEN, 3
    sizes = ((2, 256, 2 * h), (2, 256, h), (2, h, 2 * h), (2, h, h), (2, h, k), (k,))
    model = language.Model(["a", "b", "c"], *[rng.normal(0, 0.5, s).astype(np.float32) for s in sizes])
    texts = [bytes(rng.integers(1, 256, n, dtype=np.uint8)) for n in (0, 1, 5, 127, 128, 129, 1000)]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    got = language.probabilities(model, flat, np.cumsum([0, *map(len, texts)]))

    def state(way, span):
        s, out = np.zeros(h), []
        for x in span:
            gates = language._sigmoid(model.byte_gates[way, x] + s @ model.state_gates[way])
            new = np.tanh(model.byte_new[way, x] + gates[h:] * (s @ model.state_new[way]))
            s = s + gates[:h] * (new - s)
            out.append(s)
        return out

    for text, p in zip(texts, got):
        total = np.zeros(k)
        for a in range(0, len(text), language.SPAN):
            span = text[a : a + language.SPAN]
            for f, b in zip(state(0, span), state(1, span[::-1])[::-1]):
                total += language._softmax(f @ model.out[0] + b @ model.out[1] + model.bias)
        assert np.allclose(p, total / max(1, len(text)), atol=1e-4)


# 8 packing


@given_tables
def test_packing_of_all_documents(spark):
    texts = documents(spark)
    used = check_packing(QUERIES["op8_vector_best_fit_packing"](spark, SF).collect(), texts)
    least = -(-sum(len(ids(t)) + 1 for t in texts.values()) // 1024)
    assert least <= used <= 1.03 * least + 2


def test_packing_of_odd_texts(odd):
    named = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_packing(packing.pack(named, capacity=64).collect(), {r.doc_id: r.text for r in named.collect()}, 64)
    kept = packing.pack(odd, keep_ids=True).where("doc_id = 7").collect()
    assert kept[0].ids == [*ids(ODD), 2]
    assert packing.pack(empty(odd)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12), st.integers(1, 5))
def test_every_capacity_holds(counts, most):
    runs, bins = packing.plan(counts, (40, most, 1600), (1.0, 0.1, 0.1))
    fill, seen = {}, {}
    for r in sorted(runs):
        seen.setdefault(r.length, 0)
        assert r.first_rank == seen[r.length]
        later = [x.first_rank for x in runs if x.length == r.length and x.first_rank > r.first_rank]
        n = min(later, default=counts[r.length]) - r.first_rank
        seen[r.length] += n
        for i in range(n):
            fill.setdefault(r.first_bin + i // r.each, []).append((r.offset + i % r.each * r.length, r.length))
    assert seen == counts and len(fill) == bins
    for items in fill.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 40 and len(items) <= most and sum(n * n for _, n in items) <= 1600


# 9 search


@given_tables
def test_search_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = db.sql(ORACLE["op9_kd_tree_search"]).fetchall()
    assert sorted(map(tuple, QUERIES["op9_kd_tree_search"](spark, SF).collect())) == sorted(want)


def test_search_of_odd_vectors(frame):
    rng = random.Random(4)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(3)]) for i in range(300)]
    rows += [(300, None), (301, [None, 1.0, 1.0]), (302, [float("nan"), 1.0, 1.0]), (303, [float("inf")] * 3), (304, [1.0, 2.0]), (400, []), (None, [1.0] * 3)]
    rows += [(5, [0.5] * 3), (5, [0.5] * 3), (600, [1e9, -1e9, 1e9])]
    df = frame("vec_id long, embedding array<double>, shard string", *[(*r, "x") for r in rows])
    found = kdtree.top_k(df, df.where("vec_id % 100 = 0"), k=7, rows_per_shard=60).collect()
    usable = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in {i: v for i, v in usable if i % 100 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v))
        want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:7], 1)]
    assert sorted(map(tuple, found)) == sorted(want)
    assert kdtree.top_k(empty(df), empty(df)).count() == 0


# 10 secrets


@given_tables
def test_secrets_of_all_documents(spark):
    texts = documents(spark)
    for r in QUERIES["op10_automaton_secrets"](spark, SF).collect():
        want = brute_secrets(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == sha(",".join(listed)) and set(listed) <= set(r.spans.split(","))| {""}
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for k, _, _ in want) for n in ("assign", "access", "hex")]


def test_secrets_of_odd_texts(odd):
    found = secrets.find_secrets(odd, masked="clean")
    assert set(found.columns) == {*odd.columns, "clean"}
    for r in found.collect():
        assert [tuple(s) for s in r.spans] == (brute_secrets(r.text) if r.text else [])
    mine = [r for r in found.collect() if r.doc_id == 8][0]
    assert "hunter22x" not in mine.clean and "deadbeef" not in mine.clean and mine.clean.startswith("Ünï [secret]")
    assert secrets.find_secrets(empty(odd)).count() == 0


PARTS = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "AKIA", "ABCD1234", "deadbeef", "0123456789", '"', "'", " ", "=", ":", "é", "x", "-", "\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_one_pass_finds_what_the_patterns_find(text):
    assert secrets.spans_of(text, secrets.BASE) == brute_secrets(text)


def test_the_automaton_is_minimal_and_has_the_further_rules():
    scanner = secrets.scanner(secrets.BASE + secrets.MORE)
    assert len(scanner.forward.table) < scanner.forward.subsets
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 9
    assert [k for k, _, _ in secrets.spans_of(text, secrets.BASE + secrets.MORE)] == ["key", "forge"]


def test_edited_fingerprints_are_those_of_the_edited_texts(frame):
    random = np.random.default_rng(6)
    letters = list("abAB  \t.Σσİéß漢😀")
    texts = ["".join(random.choice(letters, n)) for n in [*range(0, 90, 3), *range(90, 900, 37)]]
    texts += ["ab cd " * 40, "a" * 300, "ΟΔΟΣ" * 12, "", "x" * 29 + "Σ" + "y" * 15, *("".join(random.choice(list("abcd "), n)) for n in range(20, 120))]
    found = winnowing.fingerprints(frame("doc_id long, text string", *enumerate(texts)))
    again = winnowing.winnow(found.select("doc_id", "edited", "edited_fingerprint"), "edited", "afresh").collect()
    assert len(again) == len(texts)
    assert [r.doc_id for r in again if r.afresh != r.edited_fingerprint] == []
