"""Phrases whose words stand together more often than chance, counted by stripes."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from adjudica.llm.common import ORACLE, by_bytes, documents, give_back, mix, query, ship, small_batches, text_buffer, word_hashes
from adjudica.session import materialise

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words in a candidate
TOP = 2000  # phrases reported per language
SUBSUMED = 100  # hundredths of a phrase's occurrences that a longer one must have to make it needless
UNKNOWN = "und"
BATCH_BYTES = 12 << 20  # of text that are counted together
FILTER_BITS = 1 << 26  # 8 MB, broadcast; with more frequent phrases than about 5 million it lets more through, none fewer
PROBES = 3
SLICES = 64  # parts of the stripe of a hot prefix, such as the empty one, which holds every word
HOT_SHARE = 0.001  # of a language's words from which on a prefix has as many slices; there are 1000 such prefixes at most
TOP_PARTS = 64
PARTS = 8192  # that stripes are dealt to, so a batch makes no more rows for each length however many prefixes it has

_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _PIECE.copy()
_BREAK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)

# A row has the stripes of one part: the language and prefix of each, then all their next words, joined by spaces, the
# occurrences of each, and which of the stripes it is in.
_STRIPES = "part int, langs array<string>, prefixes array<string>, next string, n array<int>, stripe array<int>"


class Words:
    """The words of some rows: their codes, the piece each stands in, and the language of its row."""

    def __init__(self, table: pa.Table):
        flat, ends = text_buffer(table["text"])
        solid = ~_BREAK[flat]
        edge = solid.copy()
        edge[1:] &= ~solid[:-1]
        at_row = ends[:-1][ends[:-1] < len(flat)]
        edge[at_row] = solid[at_row]
        starts = np.flatnonzero(edge)
        np.copyto(edge, solid)
        edge[:-1] &= ~solid[1:]
        at_row = ends[1:][ends[1:] > 0] - 1
        edge[at_row] = solid[at_row]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(np.flatnonzero(edge) + 1 - starts, out=offsets[1:])
        del edge
        data = _LOWER[flat[solid]]  # the words end to end
        del solid
        held = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = held.dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.words = coded.dictionary.cast(pa.large_string())
        del held, data
        row = (np.searchsorted(ends, starts, "right") - 1).astype(np.int32)
        breaks = np.searchsorted(np.flatnonzero(_PIECE[flat]), starts).astype(np.int32)
        new = np.ones(len(starts), bool)
        new[1:] = (row[1:] != row[:-1]) | (breaks[1:] != breaks[:-1])
        self.piece = np.cumsum(new, dtype=np.int32)
        langs = table["lang"].combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int32)[row]

    def hashes(self) -> np.ndarray:
        return word_hashes(*text_buffer(self.words), False)[0]


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(x.encode()) for x in langs.to_pylist()], np.uint64) * _STEP


def _extended(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(key * _STEP + word)


def _places(keys: np.ndarray) -> list[np.ndarray]:
    """Bits of the filter that a key sets."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return [(keys + np.uint64(j) * step) & np.uint64(FILTER_BITS - 1) for j in range(PROBES)]


def _passes(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for at in _places(keys):
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits that the phrases of a partition set, by the 64-bit word of the filter they stand in."""
    for batch in batches:
        hashes, _, _, offsets = word_hashes(*text_buffer(batch.column("phrase")), False)
        keys = _lang_hashes(batch.column("lang"))
        for j in range(int((offsets[1:] - offsets[:-1]).max(initial=0))):  # all phrases have as many words
            keys = _extended(keys, hashes[offsets[:-1] + j])
        at = np.unique(np.concatenate(_places(keys)))
        word = (at >> np.uint64(6)).astype(np.int64)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(word) else at
        yield pa.RecordBatch.from_arrays([pa.array(word[first], pa.int64()), pa.array(mask.view(np.int64), pa.int64())], names=["word", "mask"])


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """A filter of fixed size that every given phrase passes, and few others."""
    rows = phrases.select("lang", "phrase").mapInArrow(_filter_bits, "word long, mask long")
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["word"].to_numpy()] = found["mask"].to_numpy()
    return bits.view(np.uint8)


def _stripes_of(words: Words, at: np.ndarray, length: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The stripes of the phrases that begin at the given words: one per prefix, or per slice of a hot one, by their part.

    ``hot`` has the sorted keys of hot prefixes; two prefixes with one key are both hot or both not, so it may be a hash.
    A part may have several prefixes, but all of a prefix, or of its slice, is in one part.
    """
    if not len(at):
        return
    size = np.int64(len(words.words))
    # Phrases get whole numbers word by word, so that equal numbers are equal phrases.
    number = words.lang[at].astype(np.int64)
    for j in range(length):
        number = np.unique(number * size + words.codes[at + j], return_inverse=True)[1]
        if j == length - 2:
            prefix = number
    _, first, counts = np.unique(number, return_index=True, return_counts=True)
    if length == 1:
        prefix = words.lang[at]
    at, prefix, nexts = at[first], prefix[first], words.codes[at[first] + length - 1]
    hashes = words.hashes()
    slices = (hashes[nexts] >> np.uint64(40)).astype(np.int64) % SLICES
    keys = _keys(words, hashes, at, length - 1)
    if length > 1:
        slices[~np.isin(keys, hot)] = 0
    part = (_extended(keys, slices.astype(np.uint64)) % np.uint64(PARTS)).astype(np.int32)
    order = np.lexsort((slices, prefix, part))
    at, prefix, nexts, slices, counts, part = at[order], prefix[order], nexts[order], slices[order], counts[order], part[order]
    new_row = np.append(True, part[1:] != part[:-1])
    new = new_row | np.append(True, (prefix[1:] != prefix[:-1]) | (slices[1:] != slices[:-1]))
    heads, rows = np.flatnonzero(new), np.flatnonzero(new_row)
    first = np.append(np.flatnonzero(new_row[heads]), len(heads))  # stripe of each row
    within = np.cumsum(new) - 1
    within -= np.repeat(first[:-1], np.diff(np.append(rows, len(at))))
    ends = np.append(rows, len(at))
    for a in range(0, len(rows), 1000):  # rows of one batch
        b = min(a + 1000, len(rows))
        h, lo, hi = heads[first[a] : first[b]], ends[a], ends[b]
        parts = [words.words.take(pa.array(words.codes[at[h] + j])) for j in range(length - 1)]
        texts = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if len(parts) > 1 else parts[0] if parts else pa.array([""] * len(h))
        stripes, cuts = pa.array((first[a : b + 1] - first[a]).astype(np.int32)), pa.array((ends[a : b + 1] - lo).astype(np.int32))
        langs = words.langs.take(pa.array(words.lang[at[h]])).cast(pa.string())
        yield pa.RecordBatch.from_arrays([
            pa.array(part[rows[a:b]], pa.int32()), pa.ListArray.from_arrays(stripes, langs), pa.ListArray.from_arrays(stripes, texts.cast(pa.string())),
            pc.binary_join(pa.ListArray.from_arrays(cuts, words.words.take(pa.array(nexts[lo:hi])).cast(pa.string())), " "),
            *[pa.ListArray.from_arrays(cuts, pa.array(x[lo:hi].astype(np.int32))) for x in (counts, within)],
        ], names=["part", "langs", "prefixes", "next", "n", "stripe"])


def _keys(words: Words, hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit keys of the phrases of so many words that begin at the given words, as the filter has them."""
    key = _lang_hashes(words.langs)[words.lang[at]]
    for j in range(length):
        key = _extended(key, hashes[words.codes[at + j]])
    return key


def phrase_keys(phrases: list[tuple[str, str]]) -> np.ndarray:
    """The keys of a few phrases, sorted."""
    if not phrases:
        return np.zeros(0, np.uint64)
    words = Words(pa.table({"lang": pa.array([x for x, _ in phrases], pa.string()), "text": pa.array([p for _, p in phrases], pa.string())}))
    hashes, starts = words.hashes(), np.flatnonzero(np.append(True, words.piece[1:] != words.piece[:-1]))
    # All phrases have as many words.
    return np.sort(_keys(words, hashes, starts, len(words.codes) // len(phrases)))


def _counter(length: int, bits, hot: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stripes of phrases of so many words whose first and last words but one pass the filter."""

    def count(batches):
        kept = bits.value if bits is not None else None
        for table in by_bytes(batches, "text", BATCH_BYTES):
            words = Words(table)
            n = len(words.codes) - length + 1
            if n <= 0:
                continue
            at = np.arange(n)
            if length > 1:
                at = at[words.piece[:n] == words.piece[length - 1 :]]
                hashes = words.hashes()
                for shift in (0, 1):  # both phrases that are shorter by a word
                    at = at[_passes(_keys(words, hashes, at + shift, length - 1), kept)]
            yield from _stripes_of(words, at, length, hot)
            del words, at
            give_back()

    return count


def _merged(texts: DataFrame, length: int, bits, hot: np.ndarray) -> DataFrame:
    """Stripes of all batches put together entry by entry: part, lang, prefix, next, n.

    Stripes are dealt by part, which comes from prefix and slice, so a hot prefix has many tasks; entries are added up by an
    aggregation that spills, so no stripe must fit in memory.
    """
    stripes = texts.mapInArrow(_counter(length, bits, hot), _STRIPES).repartition("part")
    listed = F.arrays_zip(F.split("next", " ").alias("next"), F.col("n"), F.col("stripe"))
    entries = stripes.select("part", "langs", "prefixes", F.inline(listed).alias("next", "n", "stripe"))
    entries = entries.select("part", F.get("langs", "stripe").alias("lang"), F.get("prefixes", "stripe").alias("prefix"), "next", F.col("n").cast("long").alias("n"))
    return entries.groupBy("part", "lang", "prefix", "next").agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST
) -> tuple[list[DataFrame], DataFrame]:
    """Phrases of 1 to ``longest`` words with ``least`` or more occurrences in their language, and the words of each language.

    The tables, one per length, have lang, phrase, f, head and tail (the phrase without its last and its first word) and
    lefts and rights (occurrences of the first part and of the rest, for cuts after 1, 2, ... words). A phrase can only
    be frequent if both phrases shorter by a word are, so each pass counts only what passes a filter of those; what
    passes by chance is counted too and found infrequent.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).where("text is not null")
    none = F.array().cast("array<long>")
    found, totals = [], None
    for length in range(1, longest + 1):
        bits = spark.sparkContext.broadcast(phrase_filter(found[-1])) if found else None
        # A prefix that holds a thousandth of a language's words: few, whatever the input.
        common = found[-1].join(totals, "lang").where(F.col("f") >= HOT_SHARE * F.col("words")).select("lang", "phrase").collect() if found else []
        entries = _merged(texts, length, bits, phrase_keys([tuple(r) for r in common]))
        if length == 1:
            # The stripe of the empty prefix: its total is the number of all words.
            entries = materialise(entries, "words")
            totals = materialise(entries.groupBy("lang").agg(F.sum("n").alias("words")), "totals")  # one row per language
            now = entries.where(F.col("n") >= least).select(
                "lang", F.col("next").alias("phrase"), F.col("n").alias("f"), F.lit("").alias("head"), F.lit("").alias("tail"), none.alias("lefts"), none.alias("rights")
            )
        else:
            phrase = F.concat("prefix", F.lit(" "), "next")
            grown = entries.where(F.col("n") >= least).select(
                "lang", phrase.alias("phrase"), F.col("n").alias("f"), F.col("prefix").alias("head"), F.expr("substring(prefix || ' ' || next, instr(prefix || ' ', ' ') + 1)").alias("tail"),
            )
            before = found[-1]
            heads = before.select("lang", F.col("phrase").alias("head"), F.concat("lefts", F.array("f")).alias("lefts"))
            tails = before.select("lang", F.col("phrase").alias("tail"), F.concat(F.array("f"), "rights").alias("rights"))
            now = grown.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).select("lang", "phrase", "f", "head", "tail", "lefts", "rights")
        found.append(materialise(now, f"phrases-{length}"))
        if bits is not None:
            bits.destroy()
        if found[-1].isEmpty():
            break
    return found, totals


def scored(candidates: DataFrame) -> DataFrame:
    """Add score, l and r of the cut with the lowest score, the first one of equals; whole numbers of up to 38 digits."""
    cuts = F.expr(
        """transform(arrays_zip(lefts, rights), (x, i) -> named_struct(
            'score', (cast(1000 * f as decimal(20,0)) * cast(words as decimal(19,0))) div (cast(x.lefts as decimal(19,0)) * cast(x.rights as decimal(19,0))),
            'at', i, 'l', x.lefts, 'r', x.rights))"""
    )
    return candidates.withColumn("_cut", F.array_min(cuts)).select("*", "_cut.score", "_cut.l", "_cut.r").drop("_cut")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, longest: int = LONGEST, subsumed: int = SUBSUMED
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of every language by how much more often they occur than their parts say.

    Letters A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A null text has no words,
    a null language is ``und``; repeated rows count each; other columns are left out; a table without a frequent phrase
    gives no rows. A phrase goes where a longer candidate has ``subsumed`` hundredths of its occurrences: it is enough to look at those
    longer by one word, since in between occurrences can only fall.

    Returns lang, rank, phrase, a, l, r, n and score.
    """
    found, totals = frequent_phrases(docs, text, lang, longest, least)
    candidates = found[1:]
    if not candidates:
        candidates = [found[0].limit(0)]
    kept = []
    for shorter, longer in zip(candidates, [*candidates[1:], None]):
        if longer is not None:
            ends = longer.select("lang", F.col("head").alias("phrase"), "f").union(longer.select("lang", "tail", "f"))
            most = ends.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
            shorter = shorter.join(most, ["lang", "phrase"], "left").where(f"most is null or 100 * most < {subsumed} * f").drop("most")
        kept.append(shorter)
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    rows = scored(rows.join(totals, "lang"))
    # A language may have very many candidates, so each part of them is cut to as many as are reported before they meet.
    best = [F.col("score").desc(), F.col("f").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))).orderBy(*best)
    rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", F.col("words").alias("n"), "score")


@query
def op12_stripes_collocations(spark, sf):
    """The first 2000 collocations of every language."""
    return collocations(documents(spark, sf))


_UP_TO = range(1, LONGEST + 1)
_PHRASE = {m: " || ' ' || ".join(f"w{j}" for j in range(m)) for m in _UP_TO}
ORACLE["op12_stripes_collocations"] = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
numbered as (select lang, row_number() over () as id, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
words as (select lang, id, unnest(w) as w0, generate_subscripts(w, 1) as i from numbered),
runs as (select lang, w0, {", ".join(f"lead(w0, {j}) over (partition by id order by i) as w{j}" for j in range(1, LONGEST))} from words),
grams as ({" union all ".join(f"select lang, {_PHRASE[m]} as phrase, {m} as m, count(*) as f from runs where w{m - 1} is not null group by all having count(*) >= {LEAST}" for m in _UP_TO)}),
totals as (select lang, count(*) as n from words group by lang),
cand as (select *, string_split(phrase, ' ') as ws from grams where m > 1),
inside as (
  select distinct s.lang, s.phrase from cand l, unnest(range(1, l.m)) as a(x), unnest(range(2, l.m)) as b(y), cand s
  where x + y - 1 <= l.m and s.lang = l.lang and s.phrase = array_to_string(l.ws[x:x + y - 1], ' ') and 100 * l.f >= {SUBSUMED} * s.f
  union select distinct s.lang, s.phrase from cand l, unnest(range(2, l.m)) as b(y), cand s
  where s.lang = l.lang and s.phrase = array_to_string(l.ws[l.m - y + 1:l.m], ' ') and 100 * l.f >= {SUBSUMED} * s.f),
left_over as (select * from cand anti join inside using (lang, phrase)),
cuts as (
  select c.lang, c.phrase, c.f as a, k, x.f as l, y.f as r, t.n, ((1000::hugeint * c.f * t.n) // (x.f::hugeint * y.f))::bigint as score
  from left_over c, unnest(range(1, c.m)) as k(k) join totals t on t.lang = c.lang
  join grams x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:k], ' ') join grams y on y.lang = c.lang and y.phrase = array_to_string(c.ws[k + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from best qualify rank <= {TOP}
"""
