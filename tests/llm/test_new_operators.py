"""Ranked search, suffix dedup and collocations against brute force, with nulls, ties, empty and odd tables, and hot groups."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import collocations, queries, ranked_search, suffix_dedup, summaries
from test_small import DOCS, ODD, odd, prose, texts_of  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ranked(docs, items, top=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return term.findall((text or "").translate(LOWER))

    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc_id, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def repeats(docs, length=100):
    rows = sorted((-(2**63) if d is None else d, (t or "").encode(), d) for d, t in docs)
    first = {}
    for key, raw, _ in rows:
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            first[s] = min(first.get(s, (key, p)), (key, p))
    out = []
    for key, raw, doc_id in rows:
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < (key, p):
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def phrases(rows, threshold, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(w)
            c.update(tuple(w[i : i + j]) for j in range(1, 6) for i in range(len(w) - j + 1))
    out = []
    for lang, c in f.items():
        known = {p: a for p, a in c.items() if a >= threshold and len(p) > 1}
        inside = {p[i:j] for p, a in known.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= known[p[i:j]]}
        best = []
        for p, a in known.items():
            if p not in inside:
                score, k = min(((1000 * a * n[lang]) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(best)[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def mixture():
    """Short and long texts, shared passages, exact copies, ties and junk without blanks."""
    rng = random.Random(11)
    passage = prose(rng, 40, 300)
    pairs = [(i, " ".join(prose(rng, rng.randrange(1, 60), 300) if k % 2 else passage for k in range(rng.randrange(1, 5)))) for i in range(120)]
    pairs += [(200 + i, pairs[i][1]) for i in range(20)] + [(300, "a" * 500), (301, "xy" * 300), (302, "ab " * 200), (303, "é😀" * 150), (304, passage.replace(" ", ""))]
    return pairs + ODD


def test_search_equals_brute_force(spark, mixture, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_POSTINGS", 64)  # many blocks of one stratum
    items = [(1, mixture[3][1]), (2, mixture[9][1][:200]), (3, ""), (4, None), (5, "w1 W1 w2"), (5, "w3"), (6, "nowhere"), (None, "w7 w8")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in mixture], "doc_id long, text string, m int, block int")
    for visit in (5, 4096):
        monkeypatch.setattr(ranked_search, "FIRST_VISIT", visit)
        assert got(ranked_search.search(ranked_search.build(docs), table)) == ranked(mixture, items)
    monkeypatch.setattr(ranked_search, "BATCH_TERMS", 10)
    assert got(ranked_search.search(ranked_search.build(docs), table, 3)) == ranked(mixture, items, 3)


def test_search_of_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(ranked_search.build(none), items).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert ranked_search.search(ranked_search.build(some), items.limit(0)).collect() == []


def test_repeats_equal_brute_force(spark, mixture, monkeypatch):
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in mixture], "doc_id long, text string, key int, place int, spans int")
    want = repeats(mixture)
    assert any(r[2] for r in want)
    assert got(suffix_dedup.dedup(docs)) == want
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 20)  # hot passages cross many boundaries
    assert got(suffix_dedup.dedup(docs.repartition(5))) == want
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    assert got(suffix_dedup.dedup(docs)) == want


def test_repeats_of_empty_and_short(spark):
    schema = "doc_id long, text string"
    assert suffix_dedup.dedup(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "x" * 99), (2, "x" * 99), (3, None), (None, "")]
    assert got(suffix_dedup.dedup(spark.createDataFrame(rows, schema))) == repeats(rows)


def test_multikey_order_and_prefixes():
    rng = np.random.default_rng(3)
    rows = np.zeros((500, 24), np.uint8)
    rows[:, :17] = rng.integers(97, 99, (500, 17))
    rows[:50] = rows[50:100]
    order = suffix_dedup.multikey_order(rows)
    keys = [rows[i].tobytes() for i in order]
    assert keys == sorted(r.tobytes() for r in rows)
    shared = suffix_dedup.common_prefix(rows, order)
    assert shared[1:].tolist() == [next((k for k in range(24) if a[k] != b[k]), 24) for a, b in zip(keys, keys[1:])]


def test_collocations_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(20000)]
    fixed = ["New  York", "the\tNew York City", "a.b", "x\ny", "\x0bend", "é😀 Ärger Ü"]
    texts = [" ".join(words[i : i + 50]) + " " + rng.choice(fixed) + rng.choice([".", " ", "; "]) + rng.choice(fixed) for i in range(0, 20000, 50)]
    rows = [(t, ["en", "de", None][i % 3]) for i, t in enumerate(texts)] + [(None, "en"), ("", None), (" \t ", "fr"), ("word", "xx")]
    docs = spark.createDataFrame([(t, g, 1, "p") for t, g in rows], "text string, lang string, size int, phrase string").repartition(6)
    for threshold, top in ((20, 2000), (8, 30)):
        want = phrases(rows, threshold, top)
        assert len(want) > 20 and got(collocations.mine(docs, threshold, top)) == want
    assert collocations.mine(docs.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 10**12
    found = spark.createDataFrame([("en", "", 0, 10**15), ("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big), ("en", "a b", 2, big)], collocations.COUNTS)
    row = collocations.scored(found).first()
    assert (row["a"], row["l"], row["r"], row["score"]) == (big, 3 * big, 2 * big, 1000 * big * 10**15 // (6 * big * big))


def test_summary_loses_nothing_frequent():
    rng = np.random.default_rng(2)
    keys = np.minimum(rng.pareto(0.6, 200_000) * 50, 2**24 - 1).astype(np.uint32)
    true = Counter(keys.tolist())
    summary = summaries.Summary(100, 64)
    for part in np.array_split(keys, 40):
        own, n = np.unique(part, return_counts=True)
        summary.add(own, n)
    assert len(summary.keys) <= summary.capacity and 0 < summary.error < 100
    assert {k for k, n in true.items() if n >= 100} <= set(summary.survivors().tolist())
    assert all(true[k] - summary.error <= n <= true[k] for k, n in zip(summary.keys.tolist(), summary.counts.tolist()))


def test_packed_counts_come_back():
    found = np.concatenate([np.full(700, 5), np.full(3, 9), [11], (np.uint64(3) << np.uint64(24)) + np.arange(4, dtype=np.uint64)]).astype(np.uint64)
    rows = summaries.pack(found).to_pylist()
    counts = Counter()
    for row in rows:
        for key, n in zip(*summaries.unpack(row["ones"], row["many"])):
            counts[row["part"], int(key)] += int(n)
    assert counts == {(0, 5): 700, (0, 9): 3, (0, 11): 1, (3, 0): 1, (3, 1): 1, (3, 2): 1, (3, 3): 1}
    assert summaries.pack(np.empty(0, np.uint64)).num_rows == 0


def test_filter_keeps_every_member(spark):
    hashes = np.random.default_rng(4).integers(0, 2**63, 4000)
    members = summaries.members(spark.createDataFrame([(int(h),) for h in hashes[:2000]], "h long"))
    assert members.keeps(hashes[:2000].view(np.uint64)).all()
    assert members.keeps(hashes[2000:].view(np.uint64)).mean() < 0.05


def test_suffix_query_on_the_small_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert got(queries.op12_suffix_dedup(spark, SMALL)) == repeats(docs)
