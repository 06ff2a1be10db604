"""Corpus operators against brute force on small hand-made texts: nulls, blanks, ties, repeats, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from buyerlens.llm import chat_format, decontaminate, exact_dedup, lm_score, ngram_join, packing, quality, secrets
from buyerlens.llm import substring_dedup, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, entry string, score double"


def texts() -> list[tuple]:
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice((3, 30, 120)))) for _ in range(30)]
    near = [" ".join("changed" if k == 7 else w for k, w in enumerate(t.split())) for t in base[:8]]
    passage = " ".join(f"p{k}" for k in range(60))
    shared = [f"{t} {passage}" for t in base[:10]]
    odd = [None, "", " \t\n", "one", "One", "a b c", "Ünï çödé — text", " ".join(base) * 3, base[0], base[0], base[0] + "\n"]
    return list(enumerate(base + near + shared + odd)) + [(3, base[3]), (None, base[4]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), 1, "x", 0.5) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("picks", [1, 4])
def test_jaccard_chains(spark, monkeypatch, picks):
    """Chains whose ends are far apart, so that pivots leave much of them for pairs."""
    monkeypatch.setattr(ngram_join, "PICKS", picks)
    chains = []
    for chain in range(3):
        words = [f"c{chain}w{k}" for k in range(120)]
        for step in range(14):
            words[step * 8] = f"new{step}"
            chains.append(" ".join(words))
    order = random.Random(picks).sample(range(len(chains)), len(chains))
    rows = [(order[k], t) for k, t in enumerate(chains)]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85).collect()}
    for chain in range(3):
        own = order[14 * chain: 14 * chain + 14]
        assert {got[i] for i in own} == {min(own)}


def test_jaccard_components(docs, empty):
    lowered = {}
    for row, (i, t) in enumerate(texts()):
        w = WORD.findall((t or "").lower())
        lowered[row] = (i, frozenset(tuple(w[k: k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    up = {row: row for row in lowered}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in lowered:
        for b in range(a):
            x, y = lowered[a][1], lowered[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                up[top(a)] = top(b)
    smallest = {}
    for row, (i, s) in lowered.items():
        if i is not None:
            smallest[top(row)] = min(i, smallest.get(top(row), i))
    want = sorted((str(i), len(s), str(smallest.get(top(row)) if s else i)) for row, (i, s) in lowered.items())
    got = ngram_join.ngram_jaccard_components(docs, 4, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert ngram_join.ngram_jaccard_components(empty).count() == 0


def test_index_entries_meet_for_every_linked_pair():
    rng = np.random.default_rng(5)
    for n in (1, 5, 17, 19, 60, 400):
        pool = np.sort(rng.choice(1 << 50, n + n // 5 + 1, replace=False))
        late = pool > np.median(pool)
        for _ in range(20):
            x, y = (np.sort(rng.choice(len(pool), min(len(pool), n), replace=False)) for _ in range(2))
            common = len(np.intersect1d(x, y))
            if 100 * common >= 85 * (2 * n - common):
                a, b = (ngram_join.index_entries(n, pool[k], late[k], 85) for k in (x, y))
                assert len(np.intersect1d(a, b))


def test_exact_groups(spark, docs, empty):
    twice = [(3, "a b"), (3, "a  b"), (3, "ab "), (5, "a b  "), (8, "x y"), (8, "xy ")]  # one id, several texts
    rows = texts() + twice + [(9000, "z " * 100_000), (9001, "z" * 100_000)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows[len(texts()):], "doc_id long, text string"))
    got = sorted(((str(r.doc_id), r.text_sha256, str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_groups(frame).collect()))
    groups = {}
    for i, t in rows:
        t = t or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append(
            (len(t), i is not None, -(i or 0), hashlib.md5(t.encode()).hexdigest(), i))
    want = [(str(m[4]), hashlib.sha256(plain.encode()).hexdigest(), str(max(own)[4]), len(own), m == max(own))
            for plain, own in groups.items() for m in own]
    assert got == sorted(want)
    kept = exact_dedup.without_copies(frame).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted(
        (str(i), t) for i, t in {(max(own)[4], max(own)[3]): next(
            t or "" for j, t in rows if j == max(own)[4] and hashlib.md5((t or "").encode()).hexdigest() == max(own)[3])
            for own in groups.values()}.items() for i, t in [(i[0], t)])
    assert exact_dedup.without_copies(docs).columns == docs.columns
    assert exact_dedup.exact_groups(docs, filter_bits=64).count() == docs.count()  # a full filter only shuffles more
    assert exact_dedup.without_copies(docs, filter_bits=64).count() == exact_dedup.without_copies(docs).count()
    assert exact_dedup.without_copies(empty).count() == 0


def test_substring_dedup(docs, empty):
    rows = {(i, t) for i, t in texts()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    # Texts that share an id come in the order of a hash; here only the null ids do, and those hold no new passage.
    seen, want = {}, {}
    for place, (i, t) in enumerate(order):
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - 19):
            if seen.setdefault(tuple(w[k: k + 20]), (place, k)) != (place, k):
                gone |= set(range(k, k + 20))
        want[i, len(w)] = (len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    got = substring_dedup.without_repeats(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_removed, r.kept_text) == want[r.doc_id, r.n_words]
    assert substring_dedup.without_repeats(empty).count() == 0


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = [(i, t) for i, t in texts() if i not in (None, 3)] + [(900, "A<|endoftext|>b 'S it's \"x\"'s ×é÷ é≠ İ 1234 ...“quoted”")]
    frame = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    pieces, sequences = {}, {}
    for r in packing.pack(frame, size=64).collect():
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes() and {r.doc_tokens for r in own} == {len(ids)}
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        assert total == 64 or total & (total - 1) == 0
    assert packing.pack(empty).count() == 0


def test_benchmark_matches(spark, docs, empty):
    known = [t for _, t in texts()]
    items = spark.createDataFrame([(1, known[1]), (2, " ".join(f"p{k}" for k in range(40))), (3, None), (4, "unseen item text")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.benchmark_matches(docs, items).collect()}
    holding = {(i, 2) for i, t in texts() if "p0 p1" in (t or "")}
    assert holding <= got and all(item in (1, 2) for _, item in got)
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert not {r.doc_id for r in clean.collect()} & {i for i, _ in holding}
    assert decontaminate.benchmark_matches(empty, items).count() == 0


def test_lm_scores_cover_every_row(docs, empty):
    got = lm_score.lm_scores(docs).collect()
    assert sorted(r.n_words for r in got) == sorted(len(WORD.findall(t or "")) for _, t in texts())
    assert all((r.log_score is None) == (r.n_words == 0) and (r.log_score or -1) < 0 for r in got)
    assert lm_score.lm_scores(empty).count() == 0


def judged_texts():
    """600 texts, a fifth of them with an insult and a tenth mere repetition; labels of the first 400."""
    rng = random.Random(1)
    word = lambda: f"word{rng.randrange(200)}"
    rows, labels = [(9000, None), (9001, " "), (None, "word1 word2")], []
    for i in range(600):
        text = [word() for _ in range(40)]
        if i % 5 == 0:
            text[rng.randrange(40)] = rng.choice(("scum", "idiot"))
        elif i % 10 == 1:
            text = ["buy"] * 30
        rows.append((i, " ".join(text)))
        if i < 400:
            labels.append((i, int(i % 10 != 1), int(i % 5 == 0)))
    return rows, [*labels, (3, None, None), (4, 1, 0), (None, 1, 1), (7777, 0, 1)]


LABELS = "doc_id long, quality int, toxic int"


def test_quality_classifier_parts_held_out_texts(spark):
    rows, labels = judged_texts()
    docs = spark.createDataFrame([(i, t, 1.0, "x", 2) for i, t in rows], "doc_id long, text string, score double, kept string, doc int")
    labels = spark.createDataFrame(labels, LABELS)
    found = quality.sampled(docs, labels).collect()
    assert len(found) == len(rows) and {r.doc.kept for r in found} == {"x"}
    kept = {r.doc_id for r in found if r.kept}
    held = range(400, 600)
    good = [i for i in held if i % 5 and i % 10 != 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in held if i % 5 == 0) <= 4 and sum(i in kept for i in held if i % 10 == 1) <= 2
    assert not {9000, 9001} & kept
    assert quality.resample(docs, labels).count() == len(kept)


def test_quality_weights_follow_the_counts(spark):
    """The toxic ratio against counts of words in plain Python."""
    rows, labels = judged_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    words = {i: set((t or "").split()) for i, t in rows}
    kinds = {i: 2 if toxic else 0 if q else 1 for i, q, toxic in labels if i is not None and q is not None and i != 7777}
    n = Counter(kinds.values())
    target, known, raw = (Counter(w for i in ids for w in words[i]) for ids in (
        [i for i, k in kinds.items() if k == 0], [i for i, k in kinds.items() if k == 2], words))
    shown = [t for _, t in rows if t and t.strip()]
    got, _ = model.ratios(pa.array(shown))
    for text, value in zip(shown, got):
        want = min(math.log((target[w] + 1) / (0.5 * raw[w] * n[0] / len(rows) + 0.5 * known[w] * n[0] / n[2] + 1)) for w in set(text.split()))
        assert value == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_quality_sample_changes_with_the_seed_and_its_size_does_not(spark):
    rows, labels = judged_texts()
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    samples = [{r.doc_id for r in quality.resample(docs, labels, keep=0.4, seed=seed).collect()} for seed in (0, 1)]
    assert samples[0] != samples[1] and {len(s) for s in samples} == {round(0.4 * len(rows))}
    cold = [{r.doc_id for r in quality.resample(docs, labels, keep=0.4, seed=s, temperature=0.0).collect()} for s in (0, 1)]
    assert cold[0] == cold[1]


def test_quality_of_nothing(spark):
    rows, labels = judged_texts()
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    assert quality.sampled(docs.limit(0), labels).count() == 0
    plain = quality.sampled(docs, labels.limit(0)).collect()
    assert all(r.log_weight == (0.0 if (r.doc.text or "").strip() else quality.EMPTY) for r in plain)
    twice = quality.sampled(docs.unionByName(docs), labels).groupBy("doc_id", "text").agg(F.count_distinct("kept").alias("n"))
    assert {r.n for r in twice.collect()} == {1}  # rows that repeat go together


def test_kth_largest(spark):
    values = [random.Random(2).gauss(0, 1) for _ in range(500)] + [0.5] * 20
    frame = spark.createDataFrame([(v,) for v in values], "score double")
    for k in (1, 7, 200, 520):
        assert quality.kth_largest(frame, k) == sorted(values)[-k]
    assert quality.kth_largest(frame, 521) is None


def test_chat_format_reads_back(spark):
    tricky = ["<|im_end|>", "<\\|x", "<\\\\|", "a<|b|>\n", None, "", "ü|<|"]
    rows = [(1, k, "assistant" if k % 2 else "us<er\n\\", t) for k, t in enumerate(tricky)] + [(None, None, None, "x")]
    formatted = chat_format.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in formatted.collect():
        role, text = chat_format._read_turn(r.formatted)
        assert (r.conv_id, r.turn, role or None, text or None) in {(c, n, x, t or None) for c, n, x, t in rows}
    whole = {r.conv_id: r for r in chat_format.conversation_digests(formatted).collect()}
    learned = "".join(t or "" for _, _, x, t in rows if x == "assistant")
    assert whole[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and whole[1].loss_chars == len(learned)


def test_url_rules(spark):
    urls = {
        "http://a.net/x": ("net/", "block"), "https://EXAMPLE.net/en/1": ("example.net/en/", "allow"), "http://notnet/": (None, "allow"),
        "http://a.net?x": (None, "allow"), "http://x.org/fr/1": ("org/fr/", "allow"), "http://spam-farm.org/": (None, "block"),
        "nourl": (None, "allow"), None: (None, "allow"),
    }
    schema = "url string, host int, path string, matched int, verdict int, page string, _tokens int"
    frame = spark.createDataFrame([(u, 1, "p", 2, 3, "q", 4) for u in urls] * 2, schema)
    names = {r.name for r in url_filter.HOST_RULES}
    found = url_filter.judged(frame, url_filter.HOST_RULES + url_filter.TOKEN_RULES).collect()
    assert len(found) == 2 * len(urls)
    for r in found:
        assert (r.matched if r.matched in names else None, r.verdict) == urls[r.page.url]
        assert tuple(r.page)[1:] == (1, "p", 2, 3, "q", 4)
    assert url_filter.judged(frame.limit(0), url_filter.HOST_RULES).count() == 0


def test_many_url_rules_as_a_list_and_as_a_table(spark):
    rng = random.Random(6)
    name = lambda: "".join(rng.choice("abcde") for _ in range(rng.choice((1, 2, 3))))
    rules = {r.name: r for r in (url_filter.host_rule(
        rng.choice(("allow", "block")), ".".join(name() for _ in range(rng.choice((1, 2, 3)))),
        rng.choice(("/", f"/{name()}", f"/{name()}/"))) for _ in range(600))}
    rules = [*rules.values(), *(url_filter.token_rule("block", t) for t in ("a", "be", "ccc")),
             url_filter.Rule("always", "^[^/]*/ab", "block", (), 0)]
    urls = [f"http://{'.'.join(name() for _ in range(rng.choice((1, 2, 4))))}/{name()}/{name()}" for _ in range(800)]
    urls += ["https://a.b/" + "long/" * 5000, None, "", "http://", "no url", *urls[:50]]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")

    def verdict(u):
        if not u or "://" not in u:
            return None, "allow"
        address = u.split("://", 1)[1]
        fitting = [r for r in rules if address and re.search(r.pattern, address)]
        best = min(fitting, key=lambda r: (-r.rank, -len(r.name), r.name), default=None)
        return (best.name, best.verdict) if best else (None, "allow")

    want = sorted((str(u), *map(str, verdict(u))) for u in urls)
    as_table = spark.createDataFrame([(r.name, r.pattern, r.verdict, list(r.tokens), r.rank) for r in rules], url_filter.RULES)
    for found in (url_filter.judged(frame, rules), url_filter.judged_by_table(frame, as_table)):
        assert sorted((str(r.page.url), str(r.matched), str(r.verdict)) for r in found.collect()) == want


def test_secret_scan_held_out(spark):
    model = secrets.train(secrets.labelled_texts(spark, 2000))
    held = secrets.labelled_texts(spark, 4000).where("text IS NOT NULL").selectExpr(
        "CAST(label AS BIGINT) AS doc_id", "replace(text, 'set', 'then') AS text")
    found = secrets.scan(held, model).collect()
    assert sum(r.secret == (r.doc_id == 1) for r in found) >= 0.95 * len(found)
    assert secrets.scan(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), model).count() == 0


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def corpus(spark, tmp_path):
    """Texts with insults, exact and near copies, and passages of a benchmark; and what each stage has to keep."""
    rng = random.Random(12)
    word = lambda: f"word{rng.randrange(3000)}"
    plain = [" ".join(word() for _ in range(rng.choice((40, 80, 150)))) for _ in range(160)]
    item = " ".join(f"quiz{k}" for k in range(40))
    rows = dict(enumerate(plain))
    rows |= {200 + k: plain[k].replace(" ", "  ", 1) for k in range(6)}  # equal but for white space, longer
    rows |= {300 + k: plain[10 + k] + " oneword" for k in range(6)}  # near copies
    rows |= {400 + k: f"{plain[20 + k]} {item} {plain[30 + k]}" for k in range(4)}
    rows |= {500 + k: " ".join([*plain[k + 40].split()[:30], rng.choice(("scum", "idiot")), *plain[k + 41].split()[:30]]) for k in range(40)}
    labels = [(i, 1, 0) for i in range(0, 160, 2)] + [(i, 1, 1) for i in range(500, 530)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows.items()], DOCUMENTS).repartition(3)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = set(range(160))
    return str(tmp_path), rows, [
        rows.keys() - set(range(500, 540)),
        clean - set(range(6)) | set(range(200, 206)) | set(range(300, 306)) | set(range(400, 404)),
        clean - set(range(6)) | set(range(200, 206)) | set(range(400, 404)),
        clean - set(range(6)) | set(range(200, 206)),
    ]


def test_pipeline_keeps_what_each_stage_has_to_keep(spark, corpus):
    folder, rows, wanted = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns
        kept = {r.doc_id: r.text for r in after.collect()}
        if number == 0:  # which texts look good is up to the model, within bounds; what follows works on these
            assert len(kept.keys() & wanted[0]) >= 0.95 * len(wanted[0]) and len(kept.keys() - wanted[0]) <= 2
            after = docs.where(docs.doc_id.isin(list(wanted[0])))
        else:
            assert set(kept) == wanted[number]
        assert all(kept[i] == rows[i] for i in kept)
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == wanted[3]
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert all(tokens[r.doc_id] == r.doc_tokens for r in pieces)
    whole = corpus_pipeline.run(spark, folder)
    assert len({r.doc_id for r in whole.collect()} & wanted[3]) >= 0.95 * len(wanted[3])


def test_pipeline_of_empty_tables_and_odd_rows(spark, tmp_path, docs):
    odd = docs.select(*(c.split()[0] for c in DOCUMENTS.split(", ")))
    for name, rows in (("full", odd), ("none", odd.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/full").count() > 0


def benchmark_shares(text, item, overlap=0.8, run=5):
    """The best shares of an item's question and answer over the passages of a text, by words; None if too small."""
    plain = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
    words, own = plain(text), plain(item)
    if not own:
        return None
    cut = len(own) - len(own) // 4 if len(own) >= 4 * run else len(own)
    parts = [own[:cut], own[cut:] or own]
    reach = 1 << max(5, (len(own) - 1).bit_length())
    found = False
    for at in range(0, max(1, -(-len(words) // reach) - 1) * reach, reach):
        passage = words[at: at + 2 * reach]
        shares = []
        for part in parts:
            n = min(run, len(part))
            grams = [tuple(part[k: k + n]) for k in range(len(part) - n + 1)]
            held = {tuple(passage[k: k + n]) for k in range(len(passage) - n + 1)}
            shares.append(sum(g in held for g in grams) / len(grams))
        found |= min(shares) >= overlap - 1e-9
    return found


def test_benchmark_matches_are_those_of_brute_force(spark):
    rng = random.Random(21)
    word = lambda: rng.choice("the of and to in".split()) if rng.random() < 0.4 else f"v{rng.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(rng.choice((3, 12, 25, 60, 130))))) for k in range(30)]
    items += [(30, None), (31, " "), (32, items[3][1]), (None, items[4][1])]
    rows = []
    for i in range(150):
        text = [word() for _ in range(rng.choice((0, 4, 40, 300, 900)))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(items[:30])[1].split()
            for k in range(len(passage)):
                if rng.random() < rng.choice((0, 0.03, 0.1)):
                    passage[k] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        rows.append((i, " ".join(text)))
    rows += [(None, items[2][1]), (150, None), (151, items[5][1]), (151, items[5][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(str((i, k)) for i, t in rows for k, item in items if benchmark_shares(t, item))
    for rounds in (20_000, 10):
        got = decontaminate.benchmark_matches(docs, bench, max_items=rounds).collect()
        assert sorted(str((r.doc_id, r.item_id)) for r in got) == want
    assert len(want) > 60
    assert decontaminate.benchmark_matches(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == len(rows)
