"""JSON documents that are too large for one text, read by many tasks.

A file is scanned in pieces that end at closing braces, wherever Spark splits it, and a number of pieces in a row are a chunk.
What a piece does to the state of a reader is worked out without knowing the state before it: whether it changes from inside
a string to outside, and how many levels it opens, for either case. Put together these tell the same of a chunk, and
running values over the chunks in order give the state before each of them, from which records are cut. The records that lie in
one chunk become one small document if they are nothing but objects of one list, else each becomes one, as does a record
that goes on in the next chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adjudica.operators.ordered import LAST, PART, PLACE, SUM, XOR, placed, running
from adjudica.session import materialise
from adjudica.sources.documents import PAYLOAD
from adjudica.sources.repair import json_text, parses

_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'
_STEP = 512  # pieces of a chunk
_TOKEN = r'(?s)"(?:[^"\\]|\\.)*+"|[\[\]{}]'
_COMMA = r"^\s*,\s*"
_NEXT = _COMMA + r"\{"  # how one more record of a list begins
_LAST = 2**31 - 1
DEEPEST = 3  # levels above the records: document, block, list


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        F.col("_metadata.file_size").alias("file_size"), (F.octet_length("value") + 1).alias("bytes"), json_text(F.col("value")).alias("text"),
    )


def _outside(text: Column, inside: bool) -> Column:
    """What of a piece isn't in strings, if it begins inside a string or outside."""
    return F.regexp_replace(F.concat(F.lit('"'), text) if inside else text, _STRING, "")


def _number(text: str, *characters: str) -> Column:
    left = F.octet_length(F.lit(""))
    for c in characters:
        left = left + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return left


def _levels(plain: str) -> Column:
    """Levels that a text without strings opens less those it closes."""
    return _number(plain, "{", "[") - _number(plain, "}", "]")


def _chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pieces in a row, never more than a split of a file has, and what each of them does to the state of a reader.

    The brace that ends a piece is neither in its text nor counted. A piece turns the state if it has an odd number of
    quotation marks that aren't escaped.
    """
    unescaped = F.when(F.contains("text", F.lit("\\")), F.regexp_replace("text", r"(?s)\\.", "")).otherwise(F.col("text"))
    pieces = _pieces(spark, paths).select("*", unescaped.alias("unescaped"), _outside(F.col("text"), False).alias("o"), _outside(F.col("text"), True).alias("i"))
    piece = F.struct("row", "text", (_number("unescaped", '"') % 2).alias("turns"), _levels("o").alias("outside"), _levels("i").alias("inside"))
    pieces = pieces.select("path", "block", "row", "file_size", "bytes", piece.alias("piece"))
    # Put together where they are read, so that chunks are shuffled and not pieces.
    found = pieces.groupBy("path", "block", F.floor(F.col("row") / _STEP).alias("chunk")).agg(
        F.array_sort(F.collect_list("piece")).alias("p"), F.min("row").alias("row"), F.sum("bytes").alias("bytes"), F.max("file_size").alias("file_size")
    )
    arrays = [F.col(f"p.{n}").alias(n) for n in ("text", "turns", "outside", "inside")]
    return materialise(found.select("path", "block", "row", "bytes", "file_size", F.size("p").alias("n"), *arrays, _effect().alias("effect")), "chunks")


def _effect() -> Column:
    """What the pieces ``p`` of a chunk do if it begins outside of strings (0) or inside one (1).

    That is its turns, and its levels and the least of them at the ends of pieces, its start included, all but the brace that ends
    the last piece.
    """
    number = lambda n: F.lit(n).cast("int")
    # The brace of a piece is counted with the next one, so there is one too many at the start.
    start = F.struct(number(0).alias("turns"), number(1).alias("d0"), number(None).alias("least0"), number(0).alias("d1"), number(None).alias("least1"))

    def step(acc: Column, x: Column) -> Column:
        # Whoever began inside a string is outside wherever the other one is inside.
        within = acc["turns"] == 1
        d0, d1 = acc["d0"] - F.when(within, 0).otherwise(1), acc["d1"] - F.when(within, 1).otherwise(0)
        return F.struct(
            acc["turns"].bitwiseXOR(x["turns"]).alias("turns"), (d0 + F.when(within, x["inside"]).otherwise(x["outside"])).alias("d0"),
            F.least(acc["least0"], d0).alias("least0"), (d1 + F.when(within, x["outside"]).otherwise(x["inside"])).alias("d1"), F.least(acc["least1"], d1).alias("least1"),
        )

    return F.aggregate("p", start, step)


def _ended(i: Column) -> Column:
    """Whether the piece of this number (from 1) ends in a brace: all do but the last one of some files."""
    return ~F.col("open_end") | (i < F.col("n"))


def _after(inside: Column, depth: Column, i: Column) -> tuple[Column, Column]:
    """Whether a reader is inside a string (1 or 0) and how deep it is after a piece, from what it was before it."""
    then = inside.bitwiseXOR(F.element_at("turns", i))
    opened = F.when(inside == 1, F.element_at("inside", i)).otherwise(F.element_at("outside", i))
    return then, depth + opened - F.when((then == 0) & _ended(i), 1).otherwise(0)


def _joined(first: Column, last: Column) -> Column:
    """The text of the pieces of a chunk from one number to another."""
    some = F.slice("text", first, last - first + 1)
    return F.when(last >= first, F.concat(F.array_join(some, "}"), F.when(_ended(last), "}").otherwise(""))).otherwise("")


def _cuts() -> Column:
    """The pieces of a chunk after which no record is open, and how deep it is there."""
    none = F.array().cast("array<struct<i:int,d:int>>")
    start = F.struct(F.col("begins_inside").alias("s"), F.col("before").cast("int").alias("d"), none.alias("cuts"))

    def step(acc: Column, i: Column) -> Column:
        then, depth = _after(acc["s"], acc["d"], i)
        cut = (then == 0) & (depth <= F.col("base"))
        cuts = F.when(cut, F.concat(acc["cuts"], F.array(F.struct(i.alias("i"), depth.alias("d"))))).otherwise(acc["cuts"])
        return F.struct(then.alias("s"), depth.alias("d"), cuts.alias("cuts"))

    return F.aggregate(F.sequence(F.lit(1), F.col("n")), start, step, lambda acc: acc["cuts"])


def _inner() -> Column:
    """The records that begin and end in a chunk with cuts: one text for all that are objects of one list, else one for each."""
    steps = F.sequence(F.lit(1), F.size("cuts") - 1)
    at = lambda k: F.get("cuts", k)
    text = lambda k: _joined(at(k - 1)["i"] + 1, at(k)["i"])
    plain = F.forall(steps, lambda k: (at(k - 1)["d"] == F.col("base")) & F.rlike(F.element_at("text", at(k - 1)["i"] + 1), F.lit(_NEXT)))
    first, last = at(F.lit(0)), F.element_at("cuts", -1)
    whole = _joined(first["i"] + 1, last["i"])
    fine = plain & F.coalesce(parses(F.concat(F.lit('{"a":['), F.regexp_replace(whole, _COMMA, ""), F.lit("]}"))), F.lit(False))
    together = F.array(F.struct(F.lit(1).alias("k"), first["d"].alias("before"), last["d"].alias("after"), whole.alias("text"), F.lit(True).alias("fine")))
    single = F.transform(steps, lambda k: F.struct(k.alias("k"), at(k - 1)["d"].alias("before"), at(k)["d"].alias("after"), text(k).alias("text"), F.lit(False).alias("fine")))
    return F.when(F.size("cuts") > 1, F.when(fine, together).otherwise(single))


def _opened(text: Column, depth: Column) -> Column:
    """Key and bracket of the container that was opened last on each level, for a text that begins outside of strings."""
    level = F.struct(F.lit("").alias("key"), F.lit("").alias("bracket"))
    none = F.transform(F.sequence(F.lit(1), F.lit(DEEPEST)), lambda _: F.when(F.lit(False), level))
    start = F.struct(depth.cast("int").alias("depth"), F.lit("").alias("key"), none.alias("levels"))

    def step(acc: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        now = acc["depth"] + 1
        fresh = F.struct(acc["key"].alias("key"), token.alias("bracket"))
        levels = F.when(opens & (now <= DEEPEST), F.transform(acc["levels"], lambda x, i: F.when(i + 1 == now, fresh).otherwise(x))).otherwise(acc["levels"])
        return F.struct(
            F.when(opens, now).when(closes, acc["depth"] - 1).otherwise(acc["depth"]).alias("depth"),
            F.when(opens | closes, "").otherwise(token).alias("key"), levels.alias("levels"),
        )

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step, lambda acc: acc["levels"])


def _opener(levels: list[Column], depth: Column) -> Column:
    """What has to stand before a text that begins in these containers."""
    out = F.lit("")
    for i, level in enumerate(levels, 1):
        key = F.when(level["key"] == "", "").otherwise(F.concat(level["key"], F.lit(":"))) if i > 1 else F.lit("")
        out = F.concat(out, F.when(depth >= i, F.concat(key, level["bracket"])).otherwise(""))
    return out


def _closer(levels: list[Column], depth: Column) -> Column:
    out = F.lit("")
    for i, level in enumerate(levels, 1):
        out = F.concat(F.when(depth >= i, F.when(level["bracket"] == "[", "]").otherwise("}")).otherwise(""), out)
    return out


def read_large_documents(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """Small documents with the records of large ones, and what the files are like.

    The first table has path, payload (records of one list, or one, or what stands around the list) and readable; the second path, layout
    (null where there is no list of records) and whole (false where brackets or strings don't close). Byte order marks and NaN are mended;
    titles with bare quotation marks are not, since they can't be told from the end of a string here. A record that does
    not parse is not readable, and the others are. What is gathered in one place is one chunk or one record.
    """
    chunks = _chunks(spark, list(paths))
    # All pieces ended in a brace but the last one of a file, unless the file ends with it.
    sizes = chunks.groupBy("path").agg(F.sum("bytes").alias("read"), F.max("file_size").alias("size"), F.max(F.struct("block", "row")).alias("last"))
    # Spark leaves out a byte order mark, of three bytes.
    open_end = sizes.select("path", F.when((F.col("read") - F.col("size")).isin(1, -2), F.col("last")).alias("last"))
    # One row per file, so the chunks needn't be shuffled for it.
    known = chunks.join(F.broadcast(open_end), "path").withColumn("open_end", F.coalesce(F.struct("block", "row") == F.col("last"), F.lit(False))).drop("last")
    order = ["path", "block", "row"]
    narrow = known.select(*order, "open_end", "effect.*")
    for side in (0, 1):
        depth = F.col(f"d{side}") - ((F.col("turns") == side) & ~F.col("open_end")).cast("int")
        narrow = narrow.withColumn(f"d{side}", depth).withColumn(f"least{side}", F.least(f"least{side}", f"d{side}"))
    narrow = placed(narrow, order, "scanned")
    narrow = running(narrow, ["path"], {"in_string": (XOR, F.col("turns"))})
    begins_inside = F.col("in_string").bitwiseXOR(F.col("turns"))
    either = lambda name: F.when(begins_inside == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    narrow = narrow.select(
        *order, PART, PLACE, "open_end", "in_string", begins_inside.alias("begins_inside"), either("d").cast("long").alias("levels"), either("least").alias("least")
    )
    narrow = running(narrow, ["path"], {"depth": (SUM, F.col("levels"))}).withColumn("before", F.col("depth") - F.col("levels"))
    states = materialise(narrow.withColumn("least", F.col("before") + F.col("least")), "depths")

    # The block of records is opened on the second level; chunks that are anywhere above it are few.
    upper = chunks.join(states.where("before <= 1 or least <= 1").select(*order, PLACE, "open_end", "begins_inside", "before"), order)
    start = F.struct(F.col("begins_inside").alias("s"), F.col("before").cast("int").alias("d"), F.array().cast("array<struct<i:int,s:int,d:int>>").alias("out"))

    def above(acc: Column, i: Column) -> Column:
        then, depth = _after(acc["s"], acc["d"], i)
        here = F.array(F.struct(i.alias("i"), acc["s"].alias("s"), acc["d"].alias("d")))
        return F.struct(then.alias("s"), depth.alias("d"), F.when(acc["d"] <= 1, F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    upper = upper.withColumn("above", F.aggregate(F.sequence(F.lit(1), F.col("n")), start, above, lambda acc: acc["out"]))
    upper = upper.select("path", PLACE, F.explode(F.transform("above", lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s"), x["d"].alias("d"), _joined(x["i"], x["i"]).alias("text")))).alias("x"))
    outside = F.concat(F.when(F.col("x.s") == 1, '"').otherwise(""), F.col("x.text"))
    blocks = upper.select("path", F.struct(PLACE, "x.i").alias("at"), _opened(outside, F.col("x.d"))[1].alias("block")).where("block.key = '\"marches\"'")
    layouts = blocks.groupBy("path").agg(F.min_by("block.bracket", "at").alias("bracket"))
    ends = states.groupBy("path").agg(F.max_by(F.struct("depth", "in_string"), PLACE).alias("end"), F.min("least").alias("least"))
    files = ends.join(layouts, "path", "left").select(
        "path", F.when(F.col("bracket") == "[", "2019").when(F.col("bracket") == "{", "2022").alias("layout"),
        ((F.col("end.depth") == 0) & (F.col("end.in_string") == 0) & (F.col("least") >= 0)).alias("whole"),
    )
    files = materialise(files, "large-files")

    good = files.where("whole and layout is not null").select("path", F.when(F.col("layout") == "2019", 2).otherwise(3).alias("base"))
    cut = chunks.join(states.join(F.broadcast(good), "path").select(*order, PART, PLACE, "open_end", "begins_inside", "before", "depth", "base"), order)
    cut = cut.withColumn("cuts", _cuts())
    some, first, last = F.size("cuts") > 0, F.get("cuts", F.lit(0)), F.get("cuts", F.size("cuts") - 1)
    begin, end = F.col("before").cast("int"), F.col("depth").cast("int")

    def part(cuts: Column, k: int, before: Column, after: Column, text: Column) -> Column:
        return F.struct(cuts.alias("cuts"), F.lit(k).alias("k"), before.alias("before"), after.alias("after"), text.alias("text"))

    # What goes on from the chunk before or in the next one; there is one such record after each chunk with cuts.
    ends = F.array(part(F.lit(-1), 0, begin, first["d"], _joined(F.lit(1), first["i"])), part(F.lit(0), _LAST, last["d"], end, _joined(last["i"] + 1, F.col("n"))))
    ends = F.when(some, ends).otherwise(F.array(part(F.lit(0), 0, begin, end, _joined(F.lit(1), F.col("n")))))
    cut = cut.select("path", PART, PLACE, some.cast("long").alias("some"), F.when(some, _inner()).alias("inner"), ends.alias("ends"))
    cut = materialise(cut, "cut")
    numbered = running(cut.select("path", PART, PLACE, "some"), ["path"], {"cuts": (SUM, F.col("some"))}).select("path", PLACE, "cuts")
    parts = cut.select("path", PLACE, F.explode("ends").alias("e")).join(numbered, ["path", PLACE])
    parts = parts.select("path", (F.col("cuts") + F.col("e.cuts")).alias("open"), F.struct(F.col(PLACE).alias("place"), "e.k").alias("at"), "e.before", "e.after", "e.text")
    gathered = parts.groupBy("path", "open").agg(
        F.min("at").alias("at"), F.min_by("before", "at").alias("before"), F.max_by("after", "at").alias("after"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "").alias("text"),
    )
    inner = cut.where("inner is not null").select("path", F.col(PLACE).alias("place"), F.explode("inner").alias("r")).select("path", "place", "r.*")
    joined = inner.unionByName(gathered.select("path", "at.place", "at.k", "before", "after", "text", F.lit(False).alias("fine")))
    plain = F.regexp_replace("text", _COMMA, "")
    # A text of one more record, or of several, opens nothing above it.
    more = (F.col("before") == F.col("after")) & plain.startswith("{") & (F.col("before") >= 2)
    opened = F.when(~more, _opened(F.col("text"), F.col("before")))
    texts = materialise(joined.select("path", "place", "k", "before", "after", plain.alias("text"), "fine", opened.alias("opened")), "records")
    found = placed(texts.drop("text", "fine"), ["path", "place", "k"], "containers")
    names = [f"level{i}" for i in range(DEEPEST)]
    held = running(found, ["path"], {**{n: (LAST, F.col("opened")[i]) for i, n in enumerate(names)}, "record": (SUM, F.lit(1).cast("long"))})
    # Containers as they are before a text are those after the one before it.
    prior = held.select("path", (F.col("record") + 1).alias("record"), *[F.col(n).alias(f"prior_{n}") for n in names])
    around = held.select("path", "place", "k", "record", *names).join(prior, ["path", "record"], "left")
    both = texts.join(around, ["path", "place", "k"])
    opener = F.coalesce(_opener([F.col(f"prior_{n}") for n in names], F.col("before")), F.lit(""))
    payload = F.concat(opener, "text", F.coalesce(_closer([F.col(n) for n in names], F.col("after")), F.lit("")))
    # After the end of the document there are only blanks.
    small = both.where(~F.col("text").rlike(r"^\s*$")).select("path", payload.alias(PAYLOAD), "fine")
    readable = F.when(F.col("fine"), True).otherwise(F.coalesce(parses(F.col(PAYLOAD)), F.lit(False)))
    return small.withColumn("readable", readable).drop("fine"), files
