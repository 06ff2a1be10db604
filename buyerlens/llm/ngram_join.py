"""N-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct word shingles. Two documents link when
``100 * intersection >= percent * union``.

1. Equal sets are one entity, known by a 64-bit key. One pass over the texts
   gives each document's key and size and counts shingles in a hashed table of
   fixed size, which tells the *frequent* shingles from the others.
2. A second pass deals the remaining shingles out by hash. Each part drops those
   of a single set - they can link nothing - and counts the sets of the others.
3. All shingles have one order: by number of sets, frequent ones last. A set of
   ``n`` can miss at most ``e = n - ceil(percent * n / 100)`` shingles of a
   partner, so two linked sets share something within short prefixes. Rare
   shingles are indexed one by one. Frequent ones fall into ``GROUPS`` classes by
   hash and are indexed as pairs within a class; as a class of ``c`` shingles
   still holds a common pair unless ``c - 1`` are missing, the prefix is
   extended until rare + sum of ``c - 1`` exceeds ``e``. Very small sets, where
   that may not be reached, and very large ones, where pairs would be too many,
   are indexed by single shingles; sets near such a border get both forms.
4. Sets with a common index entry are candidates. Each entry first compares its
   members with ``PICKS`` central ones; what is linked by then needs no further
   comparison, and only members that are still apart are compared in pairs, where
   bitmaps of the sets leave a link possible.
5. Verification counts the common shingles exactly.

Shingles are 64-bit hashes, of which the number of the part and 40 bits more are
compared between documents.

Defined results: null or blank text is the empty set and links with nothing; rows
with equal sets always link; rows of one doc_id are rows of their own; a null
doc_id never becomes a component id unless there is no other; columns other than
the id and the text are ignored, whatever their names. An empty table gives no
rows. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import block_rows, components, dealt, from_planes, parts, planes, shuffle_partitions, sum_of_blocks, table, written
from buyerlens.llm.words import U, mix, release_memory, shingles, words_of

SKETCH_BITS = 18
SKETCH_BLOCK = 1 << 14
RESIDUE_BITS = 40
FLUSH = 1 << 18  # shingles that a task gathers before it hands them on
AT_ONCE = 1 << 18  # shingles of a part that are sorted at once, about
_STEP = 1 << 18  # bytes of text that are worked on at once
GROUPS = 8
PICKS = 4
BITMAP_WORDS = 8
PAIRS_FROM, PAIRS_BELOW = 16, 2000
LATE = 1 << 48  # added to the count of frequent shingles, so that they come last


def _set_keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One key per set, from the sum of its mixed shingles and its size; 0 for the empty set."""
    sums = np.concatenate((np.zeros(1, dtype=U), np.cumsum(mix(values + U(0x51ED27)))))
    sizes = np.diff(at)
    keys = mix((sums[at[1:]] - sums[at[:-1]]) + mix(sizes.astype(U) + U(0xA5A5)))
    keys[sizes == 0] = 0
    return keys.view(np.int64)


def _profile(n: int, lower: bool):
    """Key and size of each document's set; a task ends with its shingle counts."""
    names = ["doc_id", "n", "key", "block", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0)
            for w in words_of(batch.column(1), lower, step=_STEP):
                values, at = shingles(w, n)
                counts += np.bincount((values >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                rows = len(at) - 1
                yield pa.RecordBatch.from_arrays([
                    ids.slice(w.first, rows), pa.array(np.diff(at)), pa.array(_set_keys(values, at)),
                    pa.nulls(rows, kinds[3]), pa.nulls(rows, kinds[4]),
                ], names=names)
        for block, found in block_rows(counts, SKETCH_BLOCK):
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, k) for k in kinds[:3]), pa.array([block], kinds[3]), pa.array([found], kinds[4])],
                names=names,
            )

    return run


PACKED = "part int, keys binary, sizes binary, counts binary, low binary, high binary"


def _deal(n: int, lower: bool, n_parts: int, frequent: np.ndarray):
    """Shingles of each set by part: ``low`` and ``high`` hold 32 and 8 bits of each.

    Parts from ``n_parts`` on carry frequent shingles as they are: ``low`` holds
    tokens and ``high`` their counts.
    """
    names = [x.split()[0] for x in PACKED.split(", ")]

    def emit(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names
        )

    def packed(held):
        keys, sizes, tokens = (np.concatenate(x) for x in zip(*held))
        owners = np.repeat(np.arange(len(keys)), sizes)
        part = ((tokens >> U(RESIDUE_BITS)) % U(n_parts)).astype(np.int64)
        residue = tokens & U((1 << RESIDUE_BITS) - 1)
        df = frequent[(tokens >> U(64 - SKETCH_BITS)).astype(np.int64)]
        rows = []
        often = df > 0
        if often.any():
            to = n_parts + (owners[often] % n_parts)
            order = np.argsort(to, kind="stable")
            to, who = to[order], owners[often][order]
            token = ((part[often] << RESIDUE_BITS) | residue[often].astype(np.int64))[order]
            many = df[often][order]
            cuts = np.flatnonzero(np.diff(to)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(to)]):
                rows.append((int(to[a]), keys[who[a:b]].tobytes(), sizes[who[a:b]].astype(np.int32).tobytes(),
                             b"", token[a:b].tobytes(), many[a:b].tobytes()))
        part, residue, owners = part[~often], residue[~often], owners[~often]
        order = np.argsort(part.astype(np.int32), kind="stable")
        part, residue, owners = part[order], residue[order], owners[order]
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(part)]):
            if a == b:
                continue
            own = owners[a:b]
            first = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
            rows.append((int(part[a]), keys[own[first]].tobytes(), planes(sizes[own[first]], 4),
                         planes(np.diff(np.concatenate((first, [b - a]))), 4),
                         residue[a:b].astype(np.uint32).tobytes(),
                         (residue[a:b] >> U(32)).astype(np.uint8).tobytes()))
        for a in range(0, len(rows), 256):
            yield emit(rows[a: a + 256])

    def run(batches):
        for batch in batches:
            known: set[int] = set()
            held, waiting = [], 0
            for w in words_of(batch.column(0), lower, step=_STEP):
                values, at = shingles(w, n)
                own = _set_keys(values, at)
                size = np.diff(at)
                fresh = np.zeros(len(own), dtype=bool)
                for i, k in enumerate(own.tolist()):
                    if size[i] and k not in known:
                        known.add(k)
                        fresh[i] = True
                held.append((own[fresh], size[fresh], values[np.repeat(fresh, size)]))
                waiting += int(size[fresh].sum())
                if waiting > FLUSH:
                    yield from packed(held)
                    held, waiting = [], 0
            if waiting:
                yield from packed(held)

    return run


SHARED = "key long, n int, df long, token long"


def _shared_tokens(n_parts: int):
    """Of each part, the shingles that more than one set has, with the number of sets."""
    names = [x.split()[0] for x in SHARED.split(", ")]

    def frequent(rows: Iterator[tuple]):
        for _, keys, sizes, _, tokens, many in rows:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.frombuffer(keys, dtype=np.int64)), pa.array(np.frombuffer(sizes, dtype=np.int32)),
                pa.array(np.frombuffer(many, dtype=np.int64) + LATE), pa.array(np.frombuffer(tokens, dtype=np.int64)),
            ], names=names)

    def count(part: int, rows: Iterator[tuple]):
        keys, sizes, runs, low, high = [], [], [], [], []
        for _, key, size, run, four, fifth in rows:
            keys.append(np.frombuffer(key, dtype=np.int64))
            sizes.append(from_planes(size, 4).astype(np.int32))
            runs.append(from_planes(run, 4).astype(np.int32))
            low.append(np.frombuffer(four, dtype=np.uint32))
            high.append(np.frombuffer(fifth, dtype=np.uint8))
        keys, sizes = np.concatenate(keys), np.concatenate(sizes)
        low, high = np.concatenate(low), np.concatenate(high)
        owners = np.repeat(np.arange(len(keys), dtype=np.int32), np.concatenate(runs))
        # The shingles are taken by ranges of their upper bits, each small enough to be sorted in little memory.
        ends = np.cumsum(np.bincount(high, minlength=256))
        first, done = 0, 0
        while first < 256:
            to = max(first + 1, int(np.searchsorted(ends, done + AT_ONCE, side="right")))
            own = np.flatnonzero((high >= first) & (high < to))
            residues = low[own].astype(np.int64) | (high[own].astype(np.int64) << 32)
            yield from shared(part, keys, sizes, owners[own], residues)
            first, done = to, int(ends[to - 1])

    def shared(part: int, keys: np.ndarray, sizes: np.ndarray, owners: np.ndarray, residues: np.ndarray):
        order = np.argsort(residues)
        sorted_ = residues[order]
        same = sorted_[1:] == sorted_[:-1]
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        kept = order[twice]
        owners, residues = owners[kept], residues[kept]
        own, sizes = keys[owners], sizes[owners]
        order = np.lexsort((own, residues))
        own, sizes, residues = own[order], sizes[order], residues[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (residues[1:] != residues[:-1]) | (own[1:] != own[:-1])
        own, sizes, residues = own[new], sizes[new], residues[new]
        if not len(own):
            return
        starts = np.concatenate(([0], np.flatnonzero(np.diff(residues)) + 1))
        run = np.diff(np.concatenate((starts, [len(own)])))
        df = np.repeat(run, run)
        kept = df > 1
        if kept.any():
            yield pa.RecordBatch.from_arrays([
                pa.array(own[kept]), pa.array(sizes[kept]), pa.array(df[kept].astype(np.int64)),
                pa.array((np.int64(part) << RESIDUE_BITS) | residues[kept]),
            ], names=names)

    def run(batches):
        rows = (tuple(c[k].as_py() for c in batch.columns) for batch in batches for k in range(batch.num_rows))
        for part, own in groupby(rows, itemgetter(0)):
            yield from count(part, own) if part < n_parts else frequent(own)
        release_memory()

    return run


def index_entries(n: int, tokens: np.ndarray, late: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of a set of ``n`` shingles, of which ``tokens`` (in the common order) are in other sets too."""
    need = (n - -(-percent * n // 100)) + 1 - (n - len(tokens))  # single shingles still needed
    if need <= 0:
        return np.zeros(0, dtype=np.int64)
    found = []
    border = 100 * PAIRS_FROM // percent + 1
    if n < border or n >= PAIRS_BELOW:
        found.append(mix(tokens[:need].astype(U) * U(2) + U(1)))
    if PAIRS_FROM <= n < 100 * PAIRS_BELOW // percent + 1:
        rare = int(np.searchsorted(late, True))
        singles = tokens[: min(need, rare)]
        found.append(mix(singles.astype(U) * U(2)))
        need -= len(singles)
        if need > 0:
            frequent = tokens[rare:]
            group = (mix(frequent.astype(U)) % U(GROUPS)).astype(np.int64)
            seen = np.zeros(len(frequent), dtype=np.int64)
            for g in range(GROUPS):
                own = np.flatnonzero(group == g)
                seen[own] = np.arange(len(own))
            cut = int(np.searchsorted(np.cumsum(seen > 0), need)) + 1
            for g in range(GROUPS):
                own = frequent[:cut][group[:cut] == g].astype(U)
                a, b = np.triu_indices(len(own), 1)
                low, high = np.minimum(own[a], own[b]), np.maximum(own[a], own[b])
                found.append(mix(mix(low) * U(3) + high))
    return np.unique(np.concatenate(found)).view(np.int64)


def _index(percent: int):
    names = ["entry", "key", "n", "m"]

    def run(batches):
        for batch in batches:
            for key, n, order, tokens in zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(),
                                             batch.column("orders"), batch.column("tokens")):
                own = tokens.values.to_numpy()
                found = index_entries(n, own, order.values.to_numpy() >= LATE, percent)
                if len(found):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(found), pa.array(np.full(len(found), key)),
                        pa.array(np.full(len(found), n, dtype=np.int32)),
                        pa.array(np.full(len(found), len(own), dtype=np.int32)),
                    ], names=names)

    return run


def _possible(percent: int) -> str:
    """Whether sets a and b can link, from their sizes and how much of each is in other sets at all."""
    return (
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
        f" AND {100 + percent} * least(m_a, m_b) >= {percent} * (n_a + n_b)"
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by exact count of common shingles."""
    side = {x: sets.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}")) for x in "ab"}
    both = pairs.select("a", "b").join(side["a"], "a").join(side["b"], "b")
    both = both.withColumn("common", F.size(F.array_intersect("t_a", "t_b")))
    return both.where(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b")


def _side(entries: DataFrame, name: str, *more: str) -> DataFrame:
    return entries.select("entry", F.col("key").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "m", *more)))


def _pivots(members: DataFrame) -> DataFrame:
    """Of each entry, ``PICKS`` members to compare the others with: the first is one of the most central, each later one less so.

    Entries fall into four kinds, so that a group with many entries in common is
    compared with a few pivots, not with one per entry.
    """
    def pick(number: int):
        shift = F.pmod(F.xxhash64("key", F.pmod("entry", F.lit(4)), F.lit(number)), F.lit(4 * number + 1))
        best = F.min(F.struct((F.col("n") - F.col("m") + shift).alias("rank"), F.xxhash64("key", F.lit(number)).alias("h"), "key", "n", "m", "c"))
        return F.struct(best["key"].alias("a"), *(best[x].alias(f"{x}_a") for x in ("n", "m", "c")))

    return members.groupBy("entry").agg(F.array_distinct(F.array(*(pick(k) for k in range(PICKS)))).alias("picks"))


def _open(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """The members, with their components, of entries that hold several components."""
    if label is None:
        labelled = members.withColumn("c", F.col("key"))
    else:
        labelled = members.drop("c").join(label, F.col("key") == F.col("node"), "left").select(
            "entry", "key", "n", "m", F.coalesce("component", "key").alias("c"))
    mixed = written(labelled.groupBy("entry").agg(F.min("c").alias("low"), F.max("c").alias("high")).where(
        "low <> high").select("entry"), "mixed")
    return written(labelled.join(mixed, "entry", "left_semi"), "open")


def _bitmaps(batches):
    """Of each set, a bitmap of its shared shingles: sets that differ in many bits have few in common."""
    for batch in batches:
        bits = []
        for tokens in batch.column("tokens"):
            own = np.unique(mix(tokens.values.to_numpy().astype(U)) % U(64 * BITMAP_WORDS))
            words = np.zeros(BITMAP_WORDS, dtype=U)
            np.bitwise_or.at(words, (own >> U(6)).astype(np.int64), U(1) << (own & U(63)))
            bits.append(words.view(np.int64))
        columns = [batch.column("key"), *(pa.array([b[k] for b in bits], pa.int64()) for k in range(BITMAP_WORDS))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", *(f"b{k}" for k in range(BITMAP_WORDS))])


def _labels(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked sets (node) and their components; pairs already connected are not compared."""
    open_ = _open(entries, None)
    pairs = _side(open_, "b", "c").join(_pivots(open_), "entry").select(
        "b", "n_b", "m_b", "c_b", F.explode("picks").alias("p")).select("b", "n_b", "m_b", "c_b", "p.*")
    pairs = pairs.where("c_a <> c_b").where(_possible(percent))
    tried = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    near = written(components(_verified(tried, sets, percent)), "near")
    open_ = _open(open_, near)
    # What is still apart is compared in pairs, unless the bitmaps show that too few shingles are common.
    names = [f"b{k}" for k in range(BITMAP_WORDS)]
    maps = sets.select("key", "tokens").mapInArrow(_bitmaps, "key long, " + ", ".join(f"{x} long" for x in names))
    open_ = written(open_.join(maps, "key"), "mapped")
    differ = " + ".join(f"bit_count({x}_a ^ {x}_b)" for x in names)
    enough = f"{100 + percent} * (m_a + m_b - ({differ})) >= {2 * percent} * (n_a + n_b)"
    rest = _side(open_, "a", "c", *names).join(_side(open_, "b", "c", *names), "entry")
    rest = rest.where("a < b AND c_a <> c_b").where(_possible(percent)).where(enough).select("a", "b").distinct()
    late = _verified(rest.join(tried, ["a", "b"], "left_anti"), sets, percent)
    # The late links tie whole components together, so their graph has those as its nodes.
    for x in "ab":
        own = near.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
        late = late.join(own, x, "left").withColumn(f"c_{x}", F.coalesce(f"c_{x}", x))
    tied = written(components(late.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))), "tied")
    new = tied.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    moved = near.join(new, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return moved.union(tied.join(near, "node", "left_anti"))


def ngram_jaccard_components(
    docs: DataFrame, n: int = 5, percent: int = 80, lower: bool = True, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    profile = written(docs.mapInArrow(
        _profile(n, lower), "doc_id long, n long, key long, block int, counts binary"
    ), "profile")
    rows = profile.where("block IS NULL").select("doc_id", "n", "key")
    counts = sum_of_blocks(profile.where("block IS NOT NULL").select("block", "counts"), 1 << SKETCH_BITS, SKETCH_BLOCK)
    frequent = np.where(counts > 4 * counts.mean() + 256, counts, 0)

    n_parts = parts(spark)
    packed = docs.select("text").mapInArrow(_deal(n, lower, n_parts, frequent), PACKED)
    shared = dealt(packed).mapInArrow(_shared_tokens(n_parts), SHARED)
    # A frequent shingle of a set that several tasks have seen comes once from each of them.
    sets = shared.groupBy("key", "n").agg(F.array_sort(F.collect_set(F.struct("df", "token"))).alias("x"))
    sets = sets.where(f"100 * size(x) >= {percent} * n").select(
        "key", "n", F.col("x.df").alias("orders"), F.col("x.token").alias("tokens")
    )
    sets = written(sets, "sets")
    entries = written(
        sets.repartition(shuffle_partitions(spark)).mapInArrow(_index(percent), "entry long, key long, n int, m int"),
        "index",
    )
    label = _labels(entries, sets, percent)

    group = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    group = group.join(label, F.col("key") == F.col("node"), "left").where("copies > 1 OR node IS NOT NULL")
    group = written(group.select("key", "first", F.coalesce("component", "key").alias("component")), "groups")
    ids = group.groupBy("component").agg(F.min("first").alias("component_id"))
    by_key = written(group.join(ids, "component").select("key", "component_id"), "by_key")
    return rows.withColumn("key", F.when(F.col("n") > 0, F.col("key"))).join(by_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op1_ngram_jaccard_join(spark, folder: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, folder, "documents"), n=4, percent=85)
