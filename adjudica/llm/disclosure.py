"""Personal data in texts, and the words around it that give it away, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.llm.common import documents, query
from adjudica.session import materialise

KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
WINDOW = 64  # characters on either side of a hit in which words are taken for its company, where that isn't the whole text
LEAST_WORD = 3  # characters of a word that may be a term
LEAST_TEXTS = 2  # different texts in which a term must stand near an entity
GENERALISE = 0.75  # share of an entity's information from which a term is replaced by its class
REMOVE = 0.95  # share from which nothing of it stays
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
REMOVED, NAME, NUMBER, WORD = "[...]", "[NAME]", "[NUMBER]", "[WORD]"

# A run of local characters has an address or has none, wherever one begins to read it; so reading begins only
# where a run does or the hit before ended, and never goes back. The same holds for digits.
_FRESH = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    "email": _FRESH.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _FRESH.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_WORD = r"[\p{L}\p{N}_]++"
MASK = "\ue000"  # stands for each character of a hit where words around hits are looked for
_RUN = r"[\p{L}\p{N}_\ue000]++"  # a word with what it touches of hits
_BLOCK = 256
_SLACK = 1e-6  # of a share, far more than rounding can make


def running_sums(numbers: Column) -> Column:
    """Running sums of an array of numbers, block by block, so a long array isn't copied for each of its items."""

    def sums(part: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(
            part, start,
            lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"] + x)).alias("out")),
            lambda acc: acc["out"],
        )

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _BLOCK).cast("int")), lambda b: sums(F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK))))
    whole = F.flatten(F.zip_with(
        blocks, F.concat(F.array(F.lit(0).cast("long")), sums(F.transform(blocks, lambda b: F.element_at(b, -1)))),
        lambda b, before: F.transform(F.coalesce(b, F.array().cast("array<long>")), lambda x: x + before),
    ))
    return F.when(F.size(numbers) == 0, F.array().cast("array<long>")).otherwise(whole)


def _located(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """Add all hits of a pattern with their places, in code points: array of start, end (exclusive) and value."""
    rest = [F.col(f"`{c}`") for c in df.columns]
    none = F.array().cast("array<string>")
    has = F.rlike(text, F.lit(pattern))
    df = df.select(
        *rest, F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias("_hits"),
        F.when(has, F.split(text, pattern, -1)).otherwise(none).alias("_between"),
    )
    steps = F.zip_with(F.slice("_between", F.lit(1), F.size("_hits")), F.col("_hits"), lambda b, h: (F.char_length(b) + F.char_length(h)).cast("long"))
    df = df.select(*rest, "_hits", steps.alias("_steps"))
    df = df.select(*rest, "_hits", running_sums(F.col("_steps")).alias("_ends"))
    spans = F.zip_with(F.col("_hits"), F.col("_ends"), lambda h, e: F.struct((e - F.char_length(h)).alias("start"), e.alias("end"), h.alias("value")))
    return df.select(*rest, spans.alias(out))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    from_end = F.reverse(_digits(value))

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(from_end, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(from_end), F.lit(1))), F.lit(0), step)
    return F.length(_digits(value)).between(14, 19) & (total % 10 == 0)


def _small_parts(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(value, r"\."), small)


CHECKS = {"ip": _small_parts, "card": _luhn, "phone": lambda v: F.length(_digits(v)).between(10, 15)}


def _valid(kind: str) -> Column:
    """The hits of a kind that hold."""
    check = CHECKS.get(kind)
    return F.filter(kind, lambda s: check(s["value"])) if check else F.col(kind)


def _entity(kind: str, value: Column) -> Column:
    plain = {"email": F.lower, "ip": lambda v: v}.get(kind, _digits)(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def _found(docs: DataFrame, key: str, text: str, window: int | None) -> DataFrame:
    """One row per document with its hits, and its whole text with the hits masked where it has any.

    With a window each hit has the text around it instead.
    """
    df = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for kind in KINDS:
        df = _located(df, "text", PATTERNS[kind], kind)

    def plain(order: int, kind: str) -> Column:
        return F.transform(_valid(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind"), s["end"].alias("end"), _entity(kind, s["value"]).alias("entity")))

    hits = F.array_sort(F.concat(*[plain(i, kind) for i, kind in enumerate(KINDS)]))
    df = df.select("doc_id", F.xxhash64("text").alias("text_key"), F.translate("text", MASK, "\ue001").alias("text"), hits.alias("hits"), F.col("text").alias("came"))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def mask(acc: Column, h: Column) -> Column:
        at = F.greatest(acc["at"], h["start"])
        between = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (at - acc["at"]).cast("int"))
        hidden = F.repeat(F.lit(MASK), F.greatest(h["end"] - at, F.lit(0)).cast("int"))
        return F.struct(F.greatest(at, h["end"]).alias("at"), F.concat(acc["out"], between, hidden).alias("out"))

    masked = F.aggregate("hits", nothing, mask, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.char_length("text"))))
    some = F.size("hits") > 0
    df = df.select("doc_id", "text_key", "hits", F.when(some, masked).alias("masked"), F.when(some, F.sha2("came", 256)).alias("same_text"))
    if window is None:
        return df.withColumn("row", F.monotonically_increasing_id())

    def with_windows(h: Column) -> Column:
        start, end = h["start"].cast("int"), h["end"].cast("int")
        before = F.substring(F.col("masked"), F.greatest(start - window, F.lit(0)) + 1, F.least(start, F.lit(window)))
        return F.struct(
            h["start"].alias("start"), h["kind"].alias("kind"), h["end"].alias("end"), h["entity"].alias("entity"),
            before.alias("before"), F.substring(F.col("masked"), end + 1, F.lit(window)).alias("after"),
            (start <= window).alias("from_start"), (end + window >= F.char_length("masked")).alias("to_end"),
        )

    return df.select("doc_id", "text_key", F.transform("hits", with_windows).alias("hits")).withColumn("row", F.monotonically_increasing_id())


def _words(found: DataFrame) -> DataFrame:
    """Words in the windows of all hits that touch no hit: row, text_key, entity, term, start, end, value."""
    each = found.where(F.size("hits") > 0).select("row", "text_key", F.explode("hits").alias("h"))
    # A word that touches an end of a window may go on beyond it, unless the text ends there.
    first, last = "^" + _RUN, _RUN + "$"
    before, after = F.col("h.before"), F.regexp_replace("h.after", first, "")
    sides = F.array(
        F.struct((F.col("h.start") - F.char_length("h.before")).alias("at"), before.alias("window"), F.col("h.from_start").alias("open")),
        F.struct((F.col("h.end") + F.char_length("h.after") - F.char_length(after)).alias("at"), after.alias("window"), F.col("h.to_end").alias("open")),
    )
    sides = each.select("row", "text_key", F.col("h.entity").alias("entity"), F.posexplode(sides).alias("after", "s"))
    window = F.col("s.window")
    # The far end is the first of the window before, the last of the one after.
    near = F.when(F.col("after") == 0, F.regexp_replace(window, last, "")).otherwise(window)
    cut = F.when(F.col("after") == 0, F.regexp_replace(near, first, "")).otherwise(F.regexp_replace(near, last, ""))
    kept = F.when(F.col("s.open"), near).otherwise(cut)
    shift = F.when((F.col("after") == 0) & ~F.col("s.open"), F.char_length(near) - F.char_length(cut)).otherwise(0)
    sides = sides.select("row", "text_key", "entity", (F.col("s.at") + shift).alias("at"), kept.alias("window"))
    words = _located(sides, "window", _RUN, "words").select("row", "text_key", "entity", "at", F.inline("words").alias("start", "end", "value"))
    words = words.withColumns({"start": F.col("start") + F.col("at"), "end": F.col("end") + F.col("at"), "term": F.lower("value")}).drop("at")
    return words.where(_may_tell(F.col("value")))


def _may_tell(word: Column) -> Column:
    return (F.char_length(word) >= LEAST_WORD) & ~F.contains(word, F.lit(MASK))


def _entities_of(hits: str) -> Column:
    return F.array_distinct(F.transform(hits, lambda h: h["entity"]))


def _document_counts(docs: DataFrame, text: str) -> DataFrame:
    """In how many documents each word stands: term and with_term."""
    every = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(_WORD), F.lit(0)))).alias("term"))
    return every.where(F.char_length("term") >= LEAST_WORD).groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))


def _telling(pairs: DataFrame, total: int, generalise: float) -> DataFrame:
    """Terms that give an entity away: entity, term and disclosure.

    With N documents, df(e) that hold the entity, df(t) that hold the term and df(t, e) in which it stands near the entity, the
    term tells log2(N df(t, e) / (df(t) df(e))) of the log2(N / df(e)) bits that the entity has. The share is the disclosure:
    1 where the term stands nowhere but near the entity.
    """
    n = F.lit(float(max(total, 1)))
    told = F.log2(n * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    share = F.round(told / F.log2(n / F.col("with_entity")), 9)
    return pairs.where(F.col("with_entity") < total).select("entity", "term", share.alias("disclosure")).where(F.col("disclosure") >= generalise)


def _disclosing(words: DataFrame, found: DataFrame, docs: DataFrame, text: str, least_texts: int, generalise: float) -> DataFrame:
    """Terms in the windows of hits that give an entity away: entity, term and disclosure."""
    total = found.count()
    # Each document counts once for a term and an entity; copies of a text are told apart from other texts.
    per_text = words.groupBy("entity", "term", "text_key", "row").agg(F.lit(1).alias("one")).groupBy("entity", "term", "text_key").agg(F.count(F.lit(1)).alias("docs"))
    pairs = per_text.groupBy("entity", "term").agg(F.sum("docs").alias("both"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= least_texts)
    pairs = materialise(pairs, "pairs")
    entities = found.select(F.explode(_entities_of("hits")).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    return _telling(pairs.join(entities, "entity").join(_document_counts(docs, text), "term"), total, generalise)


def _marked_in_windows(found: DataFrame, docs: DataFrame, text: str, least_texts: int, generalise: float) -> DataFrame:
    """Words in the windows of hits that give an entity away: row, start, end, value and disclosure."""
    words = materialise(_words(found), "near")
    strong = _disclosing(words, found, docs, text, least_texts, generalise)
    return words.join(strong, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("disclosure"), F.first("value").alias("value"))


def _marked_in_texts(found: DataFrame, docs: DataFrame, text: str, least_texts: int, generalise: float) -> DataFrame:
    """Words of whole texts that give away an entity of the same text: row, start, end, value and disclosure.

    Copies of a text are weighed by their number and worked on once. Every word of a text is paired with every entity of
    it, but for pairs that can't reach ``generalise``: entities of too few texts, and words in so many documents that the share
    would be too small if the word stood in all documents of the entity.
    """
    total = found.count()
    having = found.where(F.size("hits") > 0)
    texts = materialise(having.groupBy("same_text").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "texts")
    holding = having.select("row", F.explode(_entities_of("hits")).alias("entity")).join(texts.select("row", "copies"), "row")
    entities = holding.groupBy("entity").agg(F.sum("copies").alias("with_entity"), F.count(F.lit(1)).alias("texts"))
    entities = entities.where((F.col("texts") >= least_texts) & (F.col("with_entity") < total)).drop("texts")
    held = materialise(holding.join(entities, "entity"), "held")

    def may_reach(with_entity: str) -> Column:
        n = F.lit(float(max(total, 1)))
        return F.log2(n / F.col("with_term")) >= (generalise - _SLACK) * F.log2(n / F.col(with_entity))

    # The most frequent entity of a text asks the least, if it asks for anything.
    loosest = F.max("with_entity") if generalise >= 0 else F.min("with_entity")
    live = held.groupBy("row").agg(loosest.alias("loosest"))
    distinct = F.array_distinct(F.transform(F.filter(F.regexp_extract_all("masked", F.lit(_RUN), F.lit(0)), _may_tell), F.lower))
    words = having.select("row", "masked").join(live, "row").select("row", "loosest", F.explode(distinct).alias("term"))
    counts = _document_counts(docs, text).where(F.col("with_term") >= least_texts)
    words = materialise(words.join(counts, "term").where(may_reach("loosest")).drop("loosest"), "words")
    # Pairs of a text are made twice and never kept, as there may be many more of them than words.
    each = words.join(held, "row").where(may_reach("with_entity"))
    pairs = each.groupBy("entity", "term", "with_entity", "with_term").agg(F.sum("copies").alias("both"), F.count(F.lit(1)).alias("texts"))
    strong = _telling(pairs.where(F.col("texts") >= least_texts), total, generalise)
    wanted = each.join(strong, ["entity", "term"]).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    wanted = materialise(wanted, "wanted")
    places = _located(having.select("row", "masked").join(wanted.select("row").distinct(), "row", "left_semi"), "masked", _RUN, "words")
    # Outer, since otherwise a filter that the optimizer infers repeats all expressions of the list.
    places = places.select("row", F.inline_outer("words").alias("start", "end", "value")).where(_may_tell(F.col("value")))
    marked = places.withColumn("term", F.lower("value")).join(wanted, ["row", "term"]).drop("term")
    # What was found in one of the copies stands in all of them.
    one = texts.select("same_text", F.col("row").alias("_first"))
    copies = having.select("row", "same_text").join(one, "same_text").select("row", "_first")
    return copies.join(marked.withColumnRenamed("row", "_first"), "_first").drop("_first")


def disclosures(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_texts: int = LEAST_TEXTS, generalise: float = GENERALISE, remove: float = REMOVE,
    window: int | None = WINDOW,
) -> DataFrame:
    """Spans of personal data in every document, and of the words near them that the corpus shows to give them away.

    Base hits are e-mail addresses, IP addresses, card and phone numbers. The values are the protected entities. A word
    within ``window`` characters of one, or of any place in its text where ``window`` is None, is compared with the whole
    corpus: where its disclosure (see ``_telling``) reaches ``generalise`` and it stands near the entity in ``least_texts``
    different texts, it becomes a span of its own, to be generalised, and from ``remove`` to be removed. What is weighed
    stands in texts with hits only, so work follows the hits.

    A null text is empty, rows with a null id and repeated rows each give a row, other columns are left out, an empty
    table gives none. Offsets are code points, ends exclusive.

    Returns doc_id, text_key (64-bit hash of the text), hits (base: start, kind, end, ...) and terms (start, end, value,
    disclosure and removed), both ordered by start.
    """
    found = materialise(_found(docs, key, text, window), "hits")
    marked = (_marked_in_texts if window is None else _marked_in_windows)(found, docs, text, least_texts, generalise)
    term = F.struct("start", "end", "value", "disclosure", (F.col("disclosure") >= remove).alias("removed"))
    # No more than the words of one document are gathered.
    terms = marked.groupBy("row").agg(F.array_sort(F.collect_list(term)).alias("terms"))
    none = F.array().cast(terms.schema["terms"].dataType)
    return found.join(terms, "row", "left").select("doc_id", "text_key", "hits", F.coalesce("terms", none).alias("terms"))


def _all_spans() -> Column:
    base = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["kind"].alias("kind"), h["end"].alias("end")))
    more = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["end"].alias("end")))
    return F.array_sort(F.concat(base, more))


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in [*KINDS, TERM]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings: float | None) -> DataFrame:
    """The documents with every hit replaced by its kind, and every word that gives one away by its class or a mark.

    Takes the settings of ``disclosures``. All columns are kept; a null text stays null. Spans that overlap are replaced
    as one, by the label of the first.
    """
    spans = disclosures(docs, key, text, **settings)
    labels = F.array(*[F.lit(LABELS[k]) for k in KINDS])
    base = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), F.get(labels, h["kind"]).alias("label")))
    kind = lambda v: F.when(v.rlike(r"^\p{N}+$"), NUMBER).when(v.rlike(r"^\p{Lu}"), NAME).otherwise(WORD)
    more = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["removed"], REMOVED).otherwise(kind(t["value"])).alias("label")))
    edits = spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.array_sort(F.concat(base, more)).alias("_edits"))
    edits = edits.where(F.size("_edits") > 0).dropDuplicates(["_id", "_key"])  # repeated rows have the same spans
    rows = docs.alias("d").join(
        edits, F.col(f"d.`{key}`").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(F.col(f"d.`{text}`"), F.lit(""))) == F.col("_key")), "left"
    )
    whole = F.col(f"d.`{text}`")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def edit(acc: Column, e: Column) -> Column:
        between = F.substring(whole, (acc["at"] + 1).cast("int"), (e["start"] - acc["at"]).cast("int"))
        fresh = e["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], e["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], between, e["label"])).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_edits", start, edit, lambda acc: F.concat(acc["out"], F.substring(whole, (acc["at"] + 1).cast("int"), F.char_length(whole))))
    new = F.when(F.col("_edits").isNull(), whole).otherwise(done)
    return rows.select(*[(new.alias(c) if c == text else F.col(f"d.`{c}`")) for c in docs.columns])


@query
def op13_information_theoretic_sanitisation(spark, sf):
    """Personal data in all documents and the words that give it away, wherever in the text they stand."""
    spans = disclosures(documents(spark, sf), window=None)
    kinds = F.transform("hits", lambda h: h["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    base = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["kind"].alias("kind"), h["end"].alias("end")))
    return spans.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(_all_spans()).alias("spans"))
