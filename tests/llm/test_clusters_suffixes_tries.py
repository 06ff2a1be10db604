"""Centroids, suffix-array dedup and the prefix trie against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from buyerlens.llm import centroids, prefix_trie, suffix_dedup

VECTORS = "vec_id long, embedding array<double>, cluster string, distance int, point int, apex int"


def vectors():
    rng = random.Random(11)
    rows = [(i, [round(rng.gauss(i % 4, 0.4), 3) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, rows[5][1]) for i in range(40)]  # one vector again and again
    rows += [(rows[7][0], rows[7][1]), (3, rows[9][1]), (None, rows[2][1]), (None, rows[2][1])]
    odd = [None, [], [1.0] * 5, [1.0] * 7, [1.0] * 5 + [None], [1.0] * 5 + [math.nan], [1.0] * 5 + [math.inf], [1e300] + [0.0] * 5]
    return rows + [(900 + i, v) for i, v in enumerate(odd)]


def clustered(rows, k, rounds, size, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            p = tuple(math.floor(scale * x) if abs(scale * x) < 1e300 else 1 << 40 for x in v)
            if max(map(abs, p)) < centroids.MOST:
                kept.append((i, p))
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)
    centres = [p for _, p in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centres)) for _, p in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            own = [p for (_, p), (_, m) in zip(kept, found) if m == n]
            if own:
                centres[n] = tuple(sum(x) // len(own) for x in zip(*own))
    return sorted((str(i), n, d) for (i, _), (d, n) in zip(kept, assign())), centres


@pytest.mark.parametrize("k, n_pivots", [(16, 5), (3, 1), (5, 12), (400, 4)])
def test_clusters(spark, k, n_pivots):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], VECTORS).repartition(3)
    want, centres = clustered(rows, k, 3, 6, 64)
    found, got = centroids.cluster(frame, k=k, size=6, n_pivots=n_pivots)
    assert [tuple(c) for c in got.tolist()] == centres
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want
    totals = centroids.with_totals(found, got).collect()
    sums = Counter()
    for _, n, d in want:
        sums[n] += d
    assert all((r.cluster_inertia, r.inertia) == (sums[r.cluster], sum(sums.values())) for r in totals)
    assert {r.centroid_sha256 for r in totals} == {
        hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest() for n in sums}


def test_clusters_of_nothing(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert centroids.with_totals(*centroids.cluster(frame)).count() == 0
    only = spark.createDataFrame([(None, [1.0] * 64)], "vec_id long, embedding array<double>")
    assert centroids.cluster(only)[0].count() == 0


def test_bounds_hold_and_spare_comparisons():
    rng = np.random.default_rng(2)
    middle = rng.integers(-200, 200, (16, 64))
    points = (middle[rng.integers(0, 16, 3000)] + rng.integers(-25, 25, (3000, 64))).astype(np.int32)
    simplex = centroids.Simplex(centroids.choose_pivots(points[:256], 12))
    apex, other = (simplex.apex(simplex.distances(x)) for x in (points, middle))
    true = ((points[:, None].astype(np.int64) - middle[None]) ** 2).sum(axis=2)
    maybe = centroids.candidates(apex, other)
    assert maybe[np.arange(3000), true.argmin(axis=1)].all()
    assert (maybe | (true > true.min(axis=1, keepdims=True))).all()
    assert maybe.mean() < 0.3  # of all pairs, the share that is compared exactly
    cluster, distance = centroids.nearest(points, apex, middle, simplex)
    assert (cluster == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()


TEXTS = "doc_id long, text string, one long, two long, spans string, part int"


def removed(rows, length):
    seen = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        seen.update(b[k: k + length] for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k: k + length]] > 1:
                gone[k: k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(i), len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def repeated_texts():
    rng = random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    base = [prose(rng.choice((20, 100, 400))) for _ in range(30)]
    passage, line = prose(90), prose(45)
    rows = [*base, *base[:6], *(t[: len(t) // 2] + "#" + t[len(t) // 2:] for t in base[:10])]
    rows += [prose(60) + passage + prose(60) for _ in range(25)] + [prose(50) + line + prose(50) for _ in range(60)]
    rows += [None, "", " ", "a" * 300, "ab" * 100, prose(5000), base[3][:41], passage]
    rows = list(enumerate(rows))
    return rows + [(7, base[7]), (7, base[8]), (None, base[9]), (None, base[9]), (None, None)]


@pytest.mark.parametrize("length", [40, 64, 100])
@pytest.mark.parametrize("filter_bits", [4, 20])
def test_suffix_dedup(spark, length, filter_bits):
    # Slices so small that the longest text comes in pieces.
    shape = suffix_dedup.Shape(length, gram=16, slice_bytes=3000, batch_bytes=2000, filter_bits=filter_bits)
    rows = repeated_texts()
    frame = spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in rows], TEXTS).repartition(3)
    got = suffix_dedup.without_repeats(frame, shape).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == removed(rows, length)


def test_suffix_dedup_with_crowded_hashes(spark, monkeypatch):
    """Every hash that repeats counts as crowded, so that all windows travel as hashes."""
    monkeypatch.setattr(suffix_dedup, "_FEW", -1)
    rows = repeated_texts()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.without_repeats(frame, suffix_dedup.Shape(64, share=1 << 30)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == removed(rows, 64)
    assert suffix_dedup.without_repeats(spark.createDataFrame([], TEXTS)).count() == 0


def test_levels_compare_bytes_when_keys_are_equal(monkeypatch):
    """All windows get one key: what is equal is decided by the bytes alone."""
    monkeypatch.setattr(suffix_dedup, "_window_keys", lambda text, places, length: np.zeros(len(places), dtype=np.uint64))
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"abcd") for _ in range(30)) for _ in range(12)]
    texts += [texts[0], b"xx" + texts[1][:20] + b"yy"]
    family = suffix_dedup.Family(12)
    for at in range(0, len(texts), 2):
        own = texts[at: at + 2]
        family.add(suffix_dedup.suffix_array(
            np.frombuffer(b"".join(own), dtype=np.uint8), np.array([len(t) for t in own]), np.arange(at, at + 2), np.arange(at, at + 2),
            np.zeros(2, dtype=np.int64), np.zeros(2, dtype=bool), 12))
    got = defaultdict(list)
    for one, _, start, stop in family.repeats():
        for k, a, b in zip(one.tolist(), start.tolist(), stop.tolist()):
            got[k].append(np.array([a, b], dtype="<i8").tobytes())
    want = removed([(k, t.decode()) for k, t in enumerate(texts)], 12)
    sizes = {str(k): int(np.subtract(*suffix_dedup.covered(v)[::-1]).sum()) for k, v in got.items()}
    assert {i: n for i, _, n, *_ in want if n} == sizes
    assert [level.weight for level in family.levels] == [4, 2, 1]


CHATS = "conv_id long, turn long, role string, text string, head string, depth int, rep int, pos int, task int"


def chats(n=240, seed=5):
    rng = random.Random(seed)
    say = [None, "", "hi", "é there", "b" * 30, "c"]
    rows = []
    for c in [*range(n), *range(-130, -95), 1 << 40]:
        for k in range(rng.choice((1, 2, 3, 6, 8))):
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(("user", "assistant", None)) if rng.random() < 0.2 else "user",
                         rng.choice(say[:3]) if k < 2 else rng.choice(say)))
    rows = [r for r in rows if not (r[0] == 100 or r[0] == 200 and r[1] != 0)]  # one base is absent, one is short
    same = [(c, k, "user", f"turn {k}") for c in range(2000, 2060) for k in range(12)]  # copies, long
    return rows + same + [rows[3], rows[3], (None, 0, "user", "x"), (None, None, None, None)]


def trie(rows, every=100, modulus=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % modulus
        whole[c] = tuple(own.get(c - int(math.fmod(c, every)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, own_members in members.items():
        ends = ",".join(str(c) for c in own_members if whole[c] == p)
        out.append((own_members[0], len(p), members[p[:-1]][0] if p else None, len(own_members), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1, 30, 100_000])
def test_prefix_trie(spark, limit):
    rows = chats()
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], CHATS).repartition(3)
    got = prefix_trie.prefix_trie(frame, limit=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)


def test_prefix_trie_of_one_conversation_over_many_tasks(spark):
    rows = [(7, k, "user", f"t{k % 50}") for k in range(3000)] + [(8, 0, "user", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = prefix_trie.prefix_trie(frame, limit=200)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], CHATS)).count() == 0
