"""Prefix trie of conversations, built as a burst trie over Spark tables.

Turns are numbered within their conversation by a range sort: a task counts along its sorted
rows, and only a conversation that goes on from one task to the next needs a carried count,
at most one per task. So one conversation may hold any share of all rows. Conversations with
the same whole sequence are reduced to one sequence with a weight before anything is built.

The trie is a set of containers. A container holds the suffixes of all sequences that share
the prefix under its head; at first there is one, below the root. Containers of more than
``limit`` turns burst, all of them in one round: the stretch that all members share becomes a
chain of nodes, and the members are dealt to new containers by the id of their next
turn. Rounds go on until no container is oversized, so a round always divides what it
touches. A container of one very long sequence needs no burst, its nodes are its rows. The
others are gathered, one task per container, sorted, and swept into nodes with a
stack. What the parts below hold (leaves, saved tokens) is then added up from the last
round to the first.

The digest of the conversations that end at a node runs over their ids in order. Ids are
first joined into strings by ranges of ids, so the one stream that a digest needs has few rows
and is never held in memory.

Defined results: rows without a conversation id belong to none and are left out; a null turn
comes first; turns at the same place come in the order of role, then text, and repeated rows are
turns of their own; null role and text are empty. ``conv_id % 100`` and so the borrowed
conversation take the sign of the id. Turns are told apart by a 128-bit digest of role
and text. An empty table gives no rows, not even a root, as no conversation is its member.
Other columns are ignored. Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buyerlens.llm.shared import short_side, shuffle_partitions, table, written

EVERY, MODULUS = 100, 6
LIMIT = 100_000  # turns that one container may hold
ID_RANGE_BITS = 12
NO_ENDS = hashlib.sha256(b"").hexdigest()

TURNS = "conv_id long, pos long, turn_id binary, chars long"
_SORTED = TURNS + ", task int"
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_at long")
_SWEPT = NODES + ", head binary, top boolean"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn_id, chars) of every turn that has a conversation."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    turn_id = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    dealt = turns.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select(
        "conv_id", turn_id.alias("turn_id"), F.char_length("text").cast("long").alias("chars"),
        F.spark_partition_id().alias("task"))

    def count(batches):
        last, pos = None, 0
        for batch in batches:
            places = []
            for conv in batch.column(0).to_pylist():
                pos = pos + 1 if conv == last else 1
                last = conv
                places.append(pos)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.int64()), *(batch.column(k) for k in (1, 2, 3))],
                names=["conv_id", "pos", "turn_id", "chars", "task"])

    # Written, as a range sort that is repeated after a loss may cut at other places.
    local = written(dealt.mapInArrow(count, _SORTED), "turns")
    ends = local.groupBy("task").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"),
                                     F.max_by("pos", F.struct("conv_id", "pos")).alias("n"))
    carried, held = [], None  # (task, conversation, turns of it in the tasks before); a row per task
    for r in ends.orderBy("task").collect():
        before = held[1] if held and held[0] == r["first"] else 0
        if before:
            carried.append((r["task"], r["first"], before))
        held = (r["last"], r["n"] + (before if r["last"] == r["first"] else 0))
    if not carried:
        return local.drop("task")
    carried = F.broadcast(spark.createDataFrame(carried, "task int, conv_id long, before long"))
    return local.join(carried, ["task", "conv_id"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id", "chars")


def rebuilt(turns: DataFrame, every: int = EVERY, modulus: int = MODULUS) -> DataFrame:
    """The turns of each conversation after the first ``h`` were replaced by those of every ``every``-th."""
    h = F.crc32(F.col("conv_id").cast("string")) % modulus
    own = turns.where(F.col("pos") > h)
    start = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < modulus)).select(
        F.col("conv_id").alias("base"), "pos", "turn_id", "chars")
    convs = turns.where("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    borrowed = convs.join(start, "base").where(F.col("pos") <= h).select("conv_id", "pos", "turn_id", "chars")
    # A base with fewer than h turns leaves a gap before the own ones, so those move up.
    had = start.groupBy("base").agg(F.count("*").alias("had"))
    short = convs.join(had, "base", "left").select(
        "conv_id", (h - F.least(h, F.coalesce("had", F.lit(0)))).alias("gap")).where("gap > 0")
    moved = own.join(short_side(short), "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "turn_id", "chars")
    return borrowed.unionByName(moved)


def _sequences(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, length, s1, s2): a 128-bit digest of every conversation's whole sequence, in any order of its rows."""
    parts = [F.xxhash64(F.lit(k), "turn_id", "pos") for k in (1, 2)]
    sums = turns.groupBy("conv_id").agg(
        F.count("*").alias("length"), *(F.bit_xor(p).alias(f"s{k}") for k, p in enumerate(parts, 1)))
    return convs.join(sums, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("length", "s1", "s2")))


def end_digests(members: DataFrame) -> DataFrame:
    """(rep, ends_sha256) from (rep, conv_id): the digest of each group's ids in order."""
    ranges = members.groupBy("rep", F.shiftright("conv_id", ID_RANGE_BITS).alias("range")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = ranges.select("rep", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digest(batches):
        rep, state = None, None
        for batch in batches:
            out = []
            for own, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own == rep:
                    state.update(b",")
                else:
                    if state:
                        out.append((rep, state.hexdigest()))
                    rep, state = own, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _digest_batch(out)
        if state:
            yield _digest_batch([(rep, state.hexdigest())])

    n = shuffle_partitions(members.sparkSession)
    return joined.repartition(n, "rep").sortWithinPartitions("rep", "range").mapInArrow(digest, "rep long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    reps, digests = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(digests)], names=["rep", "ends_sha256"])


def sweep(head: bytes, depth: int, parent: int | None, members: list[tuple[int, int, list[tuple[bytes, int]]]]) -> list[tuple]:
    """Nodes of one container: ``members`` are (conv, weight, turns from ``depth`` on), sorted here by their turns.

    Neighbours share a prefix; the nodes below the shared one are closed, each
    handing weight, smallest conversation, leaves and saved tokens to the one above.
    """
    members.sort(key=lambda m: [t for t, _ in m[2]])
    out: list[tuple] = []
    stack: list[list] = []  # open nodes: turn, chars, smallest, weight, children, leaves, saved, ends_at, children's rows

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            _, chars, conv, weight, children, leaves, saved, ends, below = stack.pop()
            leaves = leaves or 1
            saved += (weight - 1) * chars
            place = len(out)
            for k in below:  # now that the smallest conversation is known
                out[k][2] = conv
            out.append([conv, depth + len(stack), None, weight, children, leaves, saved, ends, head, not stack])
            if stack:
                up = stack[-1]
                up[2], up[3], up[4] = min(up[2], conv), up[3] + weight, up[4] + 1
                up[5], up[6] = up[5] + leaves, up[6] + saved
                up[8].append(place)
            else:
                out[place][2] = parent

    for conv, weight, turns in members:
        shared = 0
        while shared < min(len(stack), len(turns)) and stack[shared][0] == turns[shared][0]:
            shared += 1
        close(shared)
        for turn, chars in turns[shared:]:
            stack.append([turn, chars, conv, 0, 0, 0, 0, None, []])
        stack[-1][2], stack[-1][3], stack[-1][7] = min(stack[-1][2], conv), weight, conv
    close(0)
    return out


def _sweep_containers(batches):
    """Rows (head, rep, pos, depth, parent, n, turn_id, chars), sorted by head, rep, pos."""
    head, facts, members = None, None, []

    def done():
        kinds = [pa.int64()] * 8 + [pa.binary(), pa.bool_()]
        names = [x.split()[0] for x in _SWEPT.split(", ")]
        rows = sweep(head, *facts, members)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for own, rep, _, depth, parent, n, turn, chars in zip(*(c.to_pylist() for c in batch.columns)):
            if own != head:
                if members:
                    yield done()
                head, facts, members = own, (depth, parent), []
            if not members or members[-1][0] != rep:
                members.append((rep, n, []))
            members[-1][2].append((turn, chars))
    if members:
        yield done()


class _Burst(NamedTuple):
    """One round's oversized containers: their shared stretch and the containers that came out of them."""

    chains: DataFrame  # head, pos, chars
    heads: DataFrame  # head, depth, top_parent, conv_id, n_convs, last, ends_at, children
    came: DataFrame  # from, head


def trie_nodes(turns: DataFrame, convs: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """Nodes (of ``NODES``; ``ends_at`` is the weighted sequence that ends there) and members (rep, conv_id).

    ``turns`` has (conv_id, pos, turn_id, chars), ``convs`` every conversation, with or without turns.
    """
    spark = turns.sparkSession
    sequences = written(_sequences(convs, turns), "sequences")
    groups = sequences.groupBy("length", "s1", "s2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n"))
    groups = written(groups, "groups")
    members = sequences.join(groups, ["length", "s1", "s2"]).select("rep", "conv_id")
    rep_turns = turns.join(groups.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi")
    root = groups.select("rep", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("turn_id"), F.lit(0).cast("long").alias("chars"))
    rep_turns = written(root.unionByName(rep_turns.withColumnRenamed("conv_id", "rep")), "rep-turns")

    state = written(groups.select(
        "rep", "n", "length", F.lit(b"").alias("head"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent")), "state")
    nodes = spark.createDataFrame([], NODES)
    swept: list[DataFrame] = []
    bursts: list[_Burst] = []
    while True:
        left = F.col("length") - F.col("depth") + 1
        sizes = state.groupBy("head").agg(
            F.count("*").alias("reps"), F.sum(left).alias("turns"), F.sum("n").alias("n_convs"), F.min("rep").alias("conv_id"),
            F.first("depth").alias("depth"), F.first("parent").alias("top_parent"))
        sizes = written(sizes, "sizes")
        over = sizes.where((F.col("turns") > limit) & (F.col("reps") > 1))
        long = sizes.where((F.col("turns") > limit) & (F.col("reps") == 1))
        gathered = state.join(short_side(sizes.where(F.col("turns") > limit).select("head")), "head", "left_anti")
        rows = gathered.join(rep_turns, "rep").where("pos >= depth").select(
            "head", "rep", "pos", "depth", "parent", "n", "turn_id", "chars")
        swept.append(written(rows.repartition(shuffle_partitions(spark), "head").sortWithinPartitions("head", "rep", "pos")
                             .mapInArrow(_sweep_containers, _SWEPT), "swept"))
        if not long.isEmpty():
            swept.append(written(_chains_of_one(state.join(short_side(long.select("head")), "head", "left_semi"), rep_turns), "long"))
        if over.isEmpty():
            break
        burst, state = _burst(state, over, rep_turns)
        bursts.append(burst)
    below = swept[0]
    for part in swept[1:]:
        below = below.unionByName(part)
    totals = below.where("top").select("head", "n_leaves", "saved_tokens")
    nodes = nodes.unionByName(below.drop("head", "top"))
    for burst in reversed(bursts):
        chain, totals = _summed(burst, totals)
        nodes = nodes.unionByName(chain)
    return nodes, members


def _chains_of_one(state: DataFrame, rep_turns: DataFrame) -> DataFrame:
    """The nodes of containers that hold one sequence: one per turn."""
    rest = Window.partitionBy("rep").orderBy(F.desc("pos"))
    rows = state.join(rep_turns, "rep").where("pos >= depth")
    last = F.col("pos") == F.col("length")
    return rows.select(
        F.col("rep").alias("conv_id"), F.col("pos").alias("depth"),
        F.when(F.col("pos") > F.col("depth"), F.col("rep")).otherwise(F.col("parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * F.sum("chars").over(rest)).alias("saved_tokens"), F.when(last, F.col("rep")).alias("ends_at"),
        "head", (F.col("pos") == F.col("depth")).alias("top"))


def _burst(state: DataFrame, over: DataFrame, rep_turns: DataFrame) -> tuple[_Burst, DataFrame]:
    """Find each oversized container's shared stretch and deal its members by their next turn."""
    members = state.join(short_side(over.select("head")), "head", "left_semi")
    rows = members.join(rep_turns, "rep").where("pos >= depth")
    places = rows.groupBy("head", "pos").agg(
        F.count("*").alias("held"), F.min("turn_id").alias("low"), F.max("turn_id").alias("high"), F.max("chars").alias("chars"))
    places = written(places.join(short_side(over.select("head", "reps")), "head").select(
        "head", "pos", "chars", ((F.col("held") == F.col("reps")) & (F.col("low") == F.col("high"))).alias("same")), "places")
    last = places.where("NOT same").groupBy("head").agg((F.min("pos") - 1).alias("last"))
    heads = over.join(last, "head")
    ends = members.join(short_side(last), "head").where("length = last").select("head", F.col("rep").alias("ends_at"))
    heads = written(heads.join(ends, "head", "left").select(
        "head", "depth", "top_parent", "conv_id", "n_convs", "last", "ends_at"), "heads")
    chains = places.join(short_side(heads.select("head", "last")), "head").where("pos <= last").select("head", "pos", "chars")
    facts = heads.select("head", "last", F.col("conv_id").alias("above"))
    following = members.join(short_side(facts), "head").where("length > last").select("rep", "n", "length", "head", "last", "above")
    named = written(following.join(rep_turns, "rep").where("pos = last + 1").select(
        "rep", "n", "length", F.unhex(F.md5(F.concat("head", "turn_id"))).alias("head"), F.col("pos").alias("depth"),
        F.col("above").alias("parent"), F.col("head").alias("from")), "state")
    came = named.select("from", "head").distinct()
    heads = heads.join(came.groupBy(F.col("from").alias("head")).agg(F.count("*").alias("children")), "head")
    return _Burst(chains, heads, came), named.drop("from")


def _summed(burst: _Burst, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of a round's shared stretches, and leaves and saved tokens of its containers beside those given."""
    under = totals.join(burst.came, "head").groupBy(F.col("from").alias("head")).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("under"))
    rest = Window.partitionBy("head").orderBy(F.desc("pos"))
    chain = burst.chains.withColumn("chars_below", F.sum("chars").over(rest)).join(burst.heads, "head").join(under, "head")
    branch = F.col("pos") == F.col("last")
    chain = written(chain.select(
        "conv_id", F.col("pos").alias("depth_"), F.when(F.col("pos") > F.col("depth"), F.col("conv_id")).otherwise(
            F.col("top_parent")).alias("parent_conv_id"), "n_convs", F.when(branch, F.col("children")).otherwise(1).alias("n_children"),
        "n_leaves", ((F.col("n_convs") - 1) * F.col("chars_below") + F.col("under")).alias("saved_tokens"),
        F.when(branch, F.col("ends_at")).alias("ends_at"), "head", (F.col("pos") == F.col("depth")).alias("top"),
    ).withColumnRenamed("depth_", "depth"), "chain")
    totals = totals.unionByName(chain.where("top").select("head", "n_leaves", "saved_tokens"))
    return chain.drop("head", "top"), totals


def prefix_trie(conversations: DataFrame, every: int = EVERY, modulus: int = MODULUS, limit: int = LIMIT) -> DataFrame:
    """One row per node."""
    turns = numbered_turns(conversations)
    convs = turns.where("pos = 1").select("conv_id")
    nodes, members = trie_nodes(written(rebuilt(turns, every, modulus), "rebuilt"), convs, limit)
    digests = end_digests(members)
    return nodes.join(digests, nodes["ends_at"] == digests["rep"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


OP13_SQL = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), digits AS (
    SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t
), bytes AS (
    SELECT conv_id, ascii(s[CAST(k AS BIGINT)]) AS b, k FROM digits, range(1, 21) AS r(k) WHERE k <= length(s)
), polynomial AS (
    SELECT k AS byte, list_reduce(list_concat([CAST(k AS BIGINT)], CAST(range(8) AS BIGINT[])),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS value
    FROM range(256) AS r(k)
), tables AS (
    SELECT list(value ORDER BY byte) AS values FROM polynomial
), strings AS (
    SELECT conv_id, list(CAST(b AS BIGINT) ORDER BY k) AS bs FROM bytes GROUP BY conv_id
), heads AS (
    SELECT conv_id, conv_id - conv_id % {EVERY} AS base,
        xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bs),
            lambda c, b: xor(c // 256, values[xor(c % 256, b) + 1])), 4294967295) % {MODULUS} AS h
    FROM strings, tables
), rebuilt AS (
    SELECT h.conv_id, 0 AS own, t.pos, t.role, t.text FROM heads AS h JOIN t ON t.conv_id = h.base AND t.pos <= h.h
    UNION ALL
    SELECT h.conv_id, 1, t.pos, t.role, t.text FROM heads AS h JOIN t ON t.conv_id = h.conv_id AND t.pos > h.h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text FROM rebuilt
), chained AS (
    SELECT conv_id, depth, length(text) AS chars,
           sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix
    FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), lengths AS (
    SELECT conv_id, max(depth) AS length FROM chained GROUP BY conv_id
), nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           coalesce(string_agg(CASE WHEN depth = length THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
    FROM chained JOIN lengths USING (conv_id) GROUP BY depth, prefix
), up AS (
    SELECT n.depth, n.prefix, p.conv_id AS parent_conv_id, p.prefix AS parent
    FROM nodes AS n JOIN chained AS c ON c.conv_id = n.conv_id AND c.depth = n.depth - 1
    JOIN nodes AS p ON p.depth = c.depth AND p.prefix = c.prefix
), children AS (
    SELECT depth - 1 AS depth, parent AS prefix, count(*) AS n_children FROM up GROUP BY ALL
), subtree AS (
    SELECT c.depth, c.prefix, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves,
           sum((n.n_convs - 1) * n.chars) AS saved_tokens
    FROM nodes AS n JOIN chained AS c ON c.conv_id = n.conv_id AND c.depth <= n.depth
    LEFT JOIN children AS k ON k.depth = n.depth AND k.prefix = n.prefix
    GROUP BY c.depth, c.prefix
)
SELECT n.conv_id, n.depth, u.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes AS n JOIN subtree AS s USING (depth, prefix)
LEFT JOIN up AS u USING (depth, prefix) LEFT JOIN children AS k USING (depth, prefix)
"""
