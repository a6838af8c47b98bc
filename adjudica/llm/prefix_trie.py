"""Shared prefixes of conversations as a trie, its subtree sums from an Euler tour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adjudica.llm.common import ORACLE, query
from adjudica.operators.ordered import MAX, SUM, XOR, following, placed, running
from adjudica.session import materialise

BORROWED = 9  # a conversation takes fewer turns than this from another
FAMILY = 5  # conversations whose ids differ only below a multiple of this take turns from the first
BLOCK = 4096  # turns of one conversation that meet in one group
CHUNK = 1 << 16  # bytes of joined ids that travel as one row
ENTER = -1  # the chain of arcs that begins where a path is entered; others are named by the depth they leave
SUMS = ["arcs", "leaves", "saved"]


def read_turns(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet")


def numbered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Place of every turn in its conversation from 1, with the MD5 of its role and text and the bytes of its text.

    A null turn comes first, turns of one number are ordered by that MD5; null role and text are empty; turns of no
    conversation (null id) are left out.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    narrow = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.md5(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)).alias("ident"),
        F.octet_length(said).cast("long").alias("bytes"),
    )
    ordered = placed(narrow, ["conv_id", "turn", "ident"], "turns")
    return running(ordered, ["conv_id"], {"pos": (SUM, F.lit(1).cast("long"))}).select("conv_id", "pos", "ident", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are after taking their first turns from the first of their family.

    ``turns`` is from ``numbered_turns``. Returns the turns (conv_id, depth, ident, bytes, last) and all conversations
    (conv_id, length), also those left without a turn.
    """
    wanted = F.crc32(F.col("conv_id").cast("string")) % BORROWED
    first_turns = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < BORROWED))
    # No more than eight turns of a conversation are gathered.
    donors = first_turns.groupBy(F.col("conv_id").alias("donor")).agg(F.sort_array(F.collect_list(F.struct("pos", "ident", "bytes"))).alias("given"))
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = convs.select("conv_id", "own", wanted.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("donor"))
    given = F.slice(F.coalesce("given", F.array().cast(donors.schema["given"].dataType)), F.lit(1), F.col("h").cast("int"))
    taken = convs.join(donors, "donor", "left").select("conv_id", "own", "h", given.alias("given"))
    length = F.size("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    taken = materialise(taken.select("conv_id", "own", "given", F.size("given").cast("long").alias("n_given"), length.cast("long").alias("length")), "taken")

    borrowed = taken.select("conv_id", "length", F.explode("given").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), "t.ident", "t.bytes", "length"
    )
    # A long conversation meets its row in as many groups as it has blocks of turns.
    per_block = taken.select("conv_id", "n_given", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"own div {BLOCK}"))).alias("block"))
    kept = turns.where(F.col("pos") > wanted).withColumn("block", F.expr(f"pos div {BLOCK}"))
    own = kept.join(per_block, ["conv_id", "block"]).select(
        "conv_id", (F.col("n_given") + F.col("pos") - wanted).alias("depth"), "ident", "bytes", "length"
    )
    rows = borrowed.unionByName(own).withColumn("last", F.col("depth") == F.col("length")).drop("length")
    return rows, taken.select("conv_id", "length")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one node that follow each other as one text of their ids, cut into chunks."""
    node, ids, size, first = None, [], 0, None

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"depth": node[0], "a": node[1], "b": node[2], "first": first, "ids": ",".join(ids)}], schema=_CHUNKS)

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("depth", "a", "b", "conv_id")]):
            if row[:3] != node or size >= CHUNK:
                if ids:
                    yield chunk()
                node, ids, size, first = row[:3], [], 0, row[3]
            ids.append(str(row[3]))
            size += len(ids[-1]) + 1
    if ids:
        yield chunk()


_CHUNKS = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_CHUNK_SQL = "depth long, a long, b long, first long, ids string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the chunks of each node, one after the other, so no more than one chunk is held."""
    node, state, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(),) * 3 + (pa.string(),))], names=["depth", "a", "b", "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "a", "b", "ids")]):
            if key != node:
                if state:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(done) >= 1000:
            yield out()
            done = []
    if state:
        done.append((*node, state.hexdigest()))
    if done:
        yield out()


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids, ascending and joined by commas, of the conversations that end at each node.

    Ids are ordered and joined in ranges of all (node, id) pairs; what is left for one task is to hash the text of
    one node, chunk by chunk, since a SHA-256 can't be put together from parts.
    """
    order = ["depth", "a", "b", "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined_ids, _CHUNK_SQL)
    dealt = chunks.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "first")
    return dealt.mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def ranked(chains: DataFrame) -> DataFrame:
    """Sums over all chains that come before each one in the list, by pointer jumping.

    ``chains`` has conv_id and at, which name a chain, next_conv and next_at (null at the end of the list), and what is
    to be summed. Every chain points to the one before it; in each round it adds up what its pointer has and takes over
    its pointer, so a list of n chains takes about log2(n) rounds, each a join by unique keys.
    """
    before = chains.where("next_conv is not null").select(
        F.col("next_conv").alias("conv_id"), F.col("next_at").alias("at"), F.col("conv_id").alias("p_conv"), F.col("at").alias("p_at"), *SUMS
    )
    start = chains.select("conv_id", "at").join(before.select("conv_id", "at"), ["conv_id", "at"], "left_anti")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("p_conv", "p_at")]
    now = materialise(before.unionByName(start.select("conv_id", "at", *nothing, *[F.lit(0).cast("long").alias(s) for s in SUMS])), "ranks")
    while not now.where("p_conv is not null").isEmpty():
        at = now.select(*[F.col(c).alias(f"q_{c}") for c in now.columns])
        meets = (F.col("p_conv") == F.col("q_conv_id")) & (F.col("p_at") == F.col("q_at"))
        now = materialise(
            now.join(at, meets, "left").select(
                "conv_id", "at", F.col("q_p_conv").alias("p_conv"), F.col("q_p_at").alias("p_at"),
                *[(F.col(s) + F.coalesce(f"q_{s}", F.lit(0))).alias(s) for s in SUMS],
            ),
            "ranks",
        )
    return now.select("conv_id", "at", *SUMS)


def _nodes(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and which conversation ends at which node.

    A node is known by two 64-bit hashes of its turns: the exclusive or of hashes of each turn with its depth, which
    can be added up over ranges of a conversation of any length.
    """
    hashed = rows.withColumns({"ha": F.xxhash64("ident", "depth"), "hb": F.xxhash64("depth", "ident")}).drop("ident")
    ordered = placed(hashed, ["conv_id", "depth"], "rebuilt")
    members = running(ordered, ["conv_id"], {"a": (XOR, F.col("ha")), "b": (XOR, F.col("hb"))}).select(
        "conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("ha")).alias("pa"), F.col("b").bitwiseXOR(F.col("hb")).alias("pb"), "bytes", "last",
    )
    members = materialise(members, "members")
    found = members.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("bytes").alias("bytes"),
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    top = top.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", none.alias("pa"), none.alias("pb"), zero.alias("bytes"))
    ends = members.where("last").select("depth", "a", "b", "conv_id")
    turnless = convs.where("length = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id")
    return materialise(found.unionByName(top), "nodes"), ends.unionByName(turnless)


def _tree(nodes: DataFrame) -> DataFrame:
    """Nodes with the conversation of their parent, the number of children, and what they add to the sums."""
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(parent, ["depth", "pa", "pb"], "left").join(kids, ["depth", "a", "b"], "left")
    children = F.coalesce("n_children", F.lit(0)).cast("long")
    return tree.select(
        "conv_id", "depth", "a", "b", "parent_conv_id", "n_convs", children.alias("n_children"),
        F.when(children == 0, 1).otherwise(0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saving"),
    )


def _chains(tree: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The Euler tour as a list of chains: runs of arcs that follow each other along one path.

    The nodes whose smallest member is one conversation form a path downwards. The tour enters a node, goes down its own
    path first, then through its other children by ascending conversation, and leaves it. So the arcs that enter a path
    are one chain, with the arcs that leave it upwards as far as the next node with other children; from each such
    node the arcs that leave it are the start of another chain. Returns the chains, the paths and the nodes with
    other children.
    """
    paths = tree.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("leaf").alias("leaves"), F.sum("saving").alias("saved"),
        F.min_by("parent_conv_id", "depth").alias("parent"),
    )
    paths = materialise(paths, "paths")
    heads = placed(paths.where("parent is not null").select("conv_id", "parent", "top"), ["parent", "top", "conv_id"], "heads")
    siblings = following(heads, ["parent", "top"], {"sibling": F.col("conv_id")}).select("conv_id", "sibling")
    # From a path the tour goes on to its next sibling, else it leaves the parent.
    out_conv, out_at = F.coalesce("sibling", "parent"), F.when(F.col("sibling").isNotNull(), F.lit(ENTER)).when(F.col("parent").isNotNull(), F.col("top") - 1)
    ways = paths.join(siblings, "conv_id", "left").withColumns({"out_conv": out_conv, "out_at": out_at.cast("long")})
    branches = heads.groupBy(F.col("parent").alias("conv_id"), (F.col("top") - 1).alias("at")).agg(F.min("conv_id").alias("child"))
    upward = placed(branches, [F.col("conv_id"), F.col("at").desc()], "branches")
    branches = materialise(following(upward, ["conv_id"], {"above": F.col("at"), "above_child": F.col("child")}).drop("_part", "_place"), "branches")
    deepest = branches.groupBy("conv_id").agg(F.max("at").alias("above"), F.max_by("child", "at").alias("above_child"))

    def chain(rows: DataFrame, at: Column, arcs: Column, leaves: Column, saved: Column) -> DataFrame:
        on = F.col("above").isNotNull()
        return rows.select(
            "conv_id", at.cast("long").alias("at"), arcs.cast("long").alias("arcs"), leaves.cast("long").alias("leaves"), saved.cast("long").alias("saved"),
            F.when(on, F.col("above_child")).otherwise(F.col("out_conv")).alias("next_conv"),
            F.when(on, F.lit(ENTER)).otherwise(F.col("out_at")).cast("long").alias("next_at"),
        )

    upto = F.coalesce(F.col("above"), F.col("top") - 1)  # the last depth that the chain doesn't leave
    down = F.col("bottom") - F.col("top") + 1
    entering = chain(ways.join(deepest, "conv_id", "left"), F.lit(ENTER), down + F.col("bottom") - upto, F.col("leaves"), F.col("saved"))
    leaving = chain(branches.join(ways.select("conv_id", "top", "out_conv", "out_at"), "conv_id"), F.col("at"), F.col("at") - upto, F.lit(0), F.lit(0))
    return materialise(entering.unionByName(leaving), "chains"), paths, branches


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, with the sums over its subtree.

    ``turns`` are conversations with conv_id, turn, role and text; other columns are left out. See ``numbered_turns`` for
    nulls and ties: repeated rows are turns of their own. A table without a conversation gives no rows, not even a root.

    Every node has an arc that enters and one that leaves it. Arcs that follow each other along one path are put
    together to chains, the list of chains is ranked by pointer jumping, and running sums along the paths give every
    arc its place in the tour and the sums before it. A subtree's leaves and savings are the difference of the sums at
    the two arcs of its top. Nothing grows beyond a range of rows in one task: turns, nodes, siblings and branches are
    all dealt by ranges of their order.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    enter_at and exit_at, the places of the two arcs.
    """
    small_rows, convs = rebuilt(materialise(numbered_turns(turns), "numbered"))
    nodes, ends = _nodes(small_rows, convs)
    tree = materialise(_tree(nodes), "tree")
    chains, paths, branches = _chains(tree)
    ranks = ranked(chains)

    # What the tour has summed up where a path is entered (at its top) and where a chain begins to leave (at its depth).
    sizes = paths.select("conv_id", "top", "bottom", F.col("leaves").alias("pl"), F.col("saved").alias("ps"))
    first, last = ranks.where(F.col("at") == ENTER).join(sizes, "conv_id"), ranks.where(F.col("at") != ENTER)
    none = F.lit(None).cast("long")
    entered = first.select("conv_id", F.col("top").alias("depth"), F.col("arcs").alias("in_arcs"), F.col("leaves").alias("in_leaves"), F.col("saved").alias("in_saved"), *[none.alias(c) for c in ("out_arcs", "out_leaves", "out_saved")])
    turned = first.select(
        "conv_id", F.col("bottom").alias("depth"), *[none.alias(c) for c in ("in_arcs", "in_leaves", "in_saved")],
        (F.col("arcs") + 2 * F.col("bottom") - F.col("top") + 1).alias("out_arcs"), (F.col("leaves") + F.col("pl")).alias("out_leaves"), (F.col("saved") + F.col("ps")).alias("out_saved"),
    )
    left = last.select(
        "conv_id", F.col("at").alias("depth"), *[none.alias(c) for c in ("in_arcs", "in_leaves", "in_saved")],
        (F.col("arcs") + F.col("at")).alias("out_arcs"), F.col("leaves").alias("out_leaves"), F.col("saved").alias("out_saved"),
    )
    names = ["in_arcs", "in_leaves", "in_saved", "out_arcs", "out_leaves", "out_saved"]
    marks = entered.unionByName(turned).unionByName(left).groupBy("conv_id", "depth").agg(*[F.max(c).alias(c) for c in names])
    marked = placed(tree.join(marks, ["conv_id", "depth"], "left"), ["conv_id", "depth"], "marked")
    zero = F.lit(0).cast("long")
    both = running(marked, ["conv_id"], {
        "enter_at": (SUM, F.coalesce("in_arcs", F.lit(1).cast("long"))),
        "leaves_in": (SUM, F.col("leaf") + F.coalesce("in_leaves", zero)), "saved_in": (SUM, F.col("saving") + F.coalesce("in_saved", zero)),
    }, ahead={
        # Sums never fall along the tour, so the chain that leaves a node is the one with the largest of those from below.
        "out_a": (MAX, F.col("out_arcs")), "out_l": (MAX, F.col("out_leaves")), "out_s": (MAX, F.col("out_saved")),
    })
    sums = both.select(
        "conv_id", "depth", "a", "b", "parent_conv_id", "n_convs", "n_children",
        (F.col("out_l") - F.col("leaves_in") + F.col("leaf")).alias("n_leaves"),
        (F.col("out_s") - F.col("saved_in") + F.col("saving")).alias("saved_tokens"),
        "enter_at", (F.col("out_a") - F.col("depth")).alias("exit_at"),
    )
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    return sums.join(ends_digests(ends), ["depth", "a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest, "enter_at", "exit_at"
    )


@query
def op11_euler_tour_trie(spark, sf):
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie(read_turns(spark, sf)).drop("enter_at", "exit_at")


# The CRC-32 of a decimal number, bit by bit; a byte is followed by seven zeros in the list.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(c::varchar, ''), lambda d: [ascii(d)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
  lambda r, x: xor(xor(r, x) >> 1, (xor(r, x) & 1) * 3988292384)), 4294967295)"""

ORACLE["op11_euler_tour_trie"] = f"""
with turns as (
  select conv_id as c, md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce("text", '')) as ident,
    strlen(coalesce("text", ''))::bigint as size, turn from conversations where conv_id is not null),
numbered as (select *, row_number() over (partition by c order by turn nulls first, ident) as pos from turns),
convs as (select c, max(pos) as own, {_CRC} % 9 as h from numbered group by c),
given as (select v.c, n.pos, n.ident, n.size from convs v join numbered n on n.c = v.c - v.c % 5 and n.pos <= v.h),
counts as (select v.c, v.h, coalesce(max(g.pos), 0) as m from convs v left join given g on g.c = v.c group by all),
rebuilt as (select * from given union all
  select n.c, v.m + n.pos - v.h, n.ident, n.size from numbered n join counts v on v.c = n.c and n.pos > v.h),
member as (
  select c, pos as d, size, string_agg(ident, '') over (partition by c order by pos) as path, pos = max(pos) over (partition by c) as last from rebuilt
  union all select v.c, 0, 0, '', v.c not in (select c from rebuilt) from convs v),
node as (
  select d, path, min(c) as conv_id, count(*) as n_convs, any_value(size) as size,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where last), '')) as ends_sha256 from member group by d, path),
kids as (select d - 1 as d, left(path, (32 * (d - 1))::bigint) as path, count(*) as n from node where d > 0 group by all),
tree as (
  select node.*, coalesce(kids.n, 0) as n_children, up.conv_id as parent_conv_id from node left join kids using (d, path)
  left join node up on up.d = node.d - 1 and up.path = left(node.path, (32 * up.d)::bigint)),
under as (
  select m.d, m.path, sum((t.n_children = 0)::int) as n_leaves, sum((t.n_convs - 1) * t.size) as saved
  from tree t join member m on m.c = t.conv_id and m.d <= t.d group by all)
select conv_id, d::bigint as depth, parent_conv_id, n_convs, n_children, n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, ends_sha256
from tree join under using (d, path)
"""
