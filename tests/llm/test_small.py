"""Operators on small fixtures against brute force, with nulls, ties, empty tables and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from pageloom.llm import (
    decontaminate, features, jaccard_join, mixing, pii, quality_gam, quality_rules, queries, recurrent_lm, sharding, token_store, url_filter,
)
from pageloom.llm import words as W
from pageloom.sources import scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in pairs], DOCS)


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "null id text with a few words"), (None, None), (5, "é 😀 a b c d e f g " * 400)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeated rows, a long text, and extra columns whose names clash with internal ones."""
    return texts_of(spark, ODD).selectExpr("*", "1 as size", "'x' as shard", "2 as key", "3 as row", "4 as n", "5 as spans", "6 as id", "7 as score", "8 as held_out", "9 as n_words")


@pytest.fixture(scope="module")
def family(spark):
    """Near copies of a base text by edits, exact copies, strays and unrelated texts."""
    rng = random.Random(7)
    base = prose(rng, 120).split()
    pairs = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        pairs.append((i, " ".join(w)))
    pairs += [(60 + i, pairs[i][1]) for i in range(10)]
    pairs += [(100 + i, prose(rng, rng.randrange(1, 60))) for i in range(40)]
    pairs += [(200, "a b c"), (201, "a  b c"), (202, "a b"), (203, ""), (204, None)]
    return pairs


def test_words_and_shingles():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n\t ") for _ in range(rng.randrange(30))) if rng.random() > 0.1 else None for _ in range(300)]
    words = W.Words(pa.array(texts, pa.string()))
    assert words.counts.tolist() == [len(brute.words(t)) for t in texts]
    found, first = words.shingles()
    by_hash = defaultdict(set)
    for i, t in enumerate(texts):
        own = set(found[first[i] : first[i + 1]].tolist())
        assert len(own) == len(brute.shingles(t))
        if len(own) == 1:
            by_hash[own.pop()].add(tuple(brute.shingles(t))[0])
    assert all(len(x) == 1 for x in by_hash.values())


def test_pii_spans(spark):
    rng = random.Random(2)
    bits = ["a", "b.", "@", "1", "12", "255", "256", ".", "-", " ", "+1", "(", ")", "é", "😀", "a@b.c", "\n", "4111 1111 1111 1111", "1.2.3.4", "+1 (555) 123-4567"]
    pairs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for i in range(400)] + ODD
    df = texts_of(spark, pairs)
    text = defaultdict(list)
    for i, t in pairs:
        text[i].append(t)
    found = pii.digest(pii.find(df)).collect()
    assert len(found) == len(pairs)
    for r in found:
        want = {",".join(brute.personal_data(t)) for t in text[r.doc_id]}
        assert any(hashlib.sha256(w.encode()).hexdigest() == r.base_sha256 and r.spans.startswith(w) for w in want)


def test_pii_disclosing_terms(spark):
    extra = ["alpha", "bravo", "charlie", "delta"]
    pairs = [(i, f"Zarkovian wrote to zed@corp.example about {w} today") for i, w in enumerate(extra)]
    pairs += [(10 + i, f"people wrote about things today number {i}") for i in range(200)] + [(300, "Zarkovian alone"), (301, "mail x@y.example once about today")]
    df = texts_of(spark, pairs)
    spans = {r.doc_id: r.spans for r in pii.digest(pii.find(df)).collect()}
    assert spans[0] == "email:19:35,term:0:9"
    assert spans[300] == "" and spans[10] == "" and spans[301] == "email:5:16"
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "[WORD] wrote to [EMAIL] about alpha today" and clean[300] == "Zarkovian alone"


def test_pii_windows_are_terms_of_the_whole_text(spark):
    rng = random.Random(12)
    bits = ["Zarkovian", "born", "1985", "12-34", "pays", "with", "é", "Élan", "abc", "😀", "4111 1111 1111 1111", "a.name@corp.example", "+1 (555) 123-4567", "10.0.0.1", "-" * 200, "ünder", "x"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(120))) for _ in range(60)] + ["Zarkovian, born 1985, pays with 4111 1111 1111 1111", "Zarkovian " + "- " * 200 + "a@b.example", "naïvea@b.exampleß4111111111111111", None]
    texts.append(" ".join(["word", "mail@corp.example", "and", "Other"] * 300))
    got = pii.base_spans(texts_of(spark, list(enumerate(texts)))).select("doc_id", "spans").collect()
    assert len(got) == len(texts)
    for r in got:
        terms = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]{4,}", texts[r.doc_id] or "")]
        assert [f"{x.kind}:{x.s}:{x.e}" for x in r.spans] == brute.personal_data(texts[r.doc_id])
        for x in r.spans:
            assert x.left == [t for _, e, t in terms if e <= x.s][-6:]
            assert x.right == [t for s, _, t in terms if s >= x.e][:6]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "a://", "http://EXAMPLE.com/en/x?y", "http://www.example.com/en/", "https://a.net/es/", "https://a.net/ES/", "x://b.org#/", "http://net/fr/\n#", "http://xcom/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    model = url_filter.train(url_filter.default_table(spark))
    got = {r.page_id: r for r in url_filter.judge(df, queries.URL_RULES, model).collect()}
    want = {4: ("example.com", "/en/x", "example.com/en/", "block"), 5: ("www.example.com", "/en/", "www.example.com/en/", "allow"), 6: ("a.net", "/es/", "net/es/", "block"), 9: ("net", "/fr/\n", "net/fr/", "block")}
    for k, u in enumerate(urls):
        r = got[k]
        if k in want:
            assert (r.host, r.path, r.rule, r.verdict) == want[k]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")
        if u is None or "://" not in u:
            assert (r.host, r.path, r.verdict) == ("", "", "allow")
    fresh = [(1, "http://mega-casino.test/slots"), (1, "http://cheap-pills.test/buy"), (0, "http://www.theatre.test/en/31"), (0, "https://blog.rivers.test/de/7")]
    judged = url_filter.judge(spark.createDataFrame([(i, u) for i, (_, u) in enumerate(fresh)], "page_id long, url string"), [], model).collect()
    assert [int(r.verdict == "block") for r in sorted(judged)] == [y for y, _ in fresh]


def test_mixing_shares_and_prefix(spark, odd):
    rng = random.Random(3)
    pairs = [(i, prose(rng, rng.randrange(1, 40))) for i in range(400)]
    df = texts_of(spark, pairs).withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "de").otherwise("en")).withColumn("domain", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    weights = {"domain": {"a": 0.8, "b": 0.2}, "lang": {"en": 0.5, "de": 0.5}}
    taken = mixing.mix(df, weights, budget_share=0.9, max_epochs=1).toPandas()
    leaf, n = {}, {}
    for r in df.collect():
        key = (r.domain, r.lang, r.source)
        n[r.doc_id] = len(brute.words(r.text))
        leaf[key] = leaf.get(key, 0) + n[r.doc_id]

    def fill(children, budget):
        out, live = {}, dict(children)
        while live:
            w = sum(x[1] for x in live.values())
            full = [k for k, (cap, wt) in live.items() if cap <= budget * wt / w + 1e-9]
            if not full:
                return out | {k: budget * wt / w for k, (_, wt) in live.items()}
            for k in full:
                out[k] = live.pop(k)[0]
            budget -= sum(out[k] for k in full)
        return out

    def split(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        level = weights.get(mixing.LEVELS[len(prefix)], {})
        kids = {k[: len(prefix) + 1] for k in leaf if k[: len(prefix)] == prefix}
        children = {k: (sum(v for key, v in leaf.items() if key[: len(k)] == k), level.get(k[-1], 1.0)) for k in kids}
        return {a: b for k, got in fill(children, budget).items() for a, b in split(k, got).items()}

    want = split((), 0.9 * sum(leaf.values()))
    got = taken.groupby(["domain", "lang", "source"]).take_tokens.sum().to_dict()
    assert all(abs(want[k] - got.get(k, 0)) < 1.001 for k in want)
    assert (taken.take_tokens <= taken.n_tokens).all() and (taken.take_tokens > 0).all()
    assert (taken.take_tokens < taken.n_tokens).sum() <= len(leaf) and taken.doc_id.is_unique
    assert mixing.mix(df.limit(0), weights).count() == 0
    blanks = mixing.mix(odd.withColumn("domain", F.lit(None).cast("string")), {}, budget_share=2.0)
    assert sorted((r.doc_id or 0, r.epoch) for r in blanks.collect()) == sorted([(4, 0), (4, 1)] * 2 + [(0, 0), (0, 1), (5, 0), (5, 1)])


def test_jaccard_classes(spark, family):
    got = {r.doc_id: r for r in jaccard_join.join(texts_of(spark, family)).collect()}
    want, linked = brute.classes(dict(family))
    assert {d: r.class_id for d, r in got.items()} == want
    assert {d for d, r in got.items() if r.n_links} == linked
    assert got[0].n_copies == 2 and got[203].n_copies == 1


def _all_links(texts, threshold=0.8):
    """Links of every text to different texts by comparing all pairs."""
    sets = {t: brute.shingles(t) for t in set(texts.values()) if brute.shingles(t)}
    out = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            out[a] += 1
            out[b] += 1
    return {i: out.get(t, 0) for i, t in texts.items()}


def _edited(rng, base, most, vocabulary):
    w = list(base)
    for _ in range(rng.randrange(most + 1)):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(vocabulary)}"
    return " ".join(w)


@pytest.mark.parametrize("short", [jaccard_join.SHORT, 5])
def test_jaccard_counts_every_link(spark, family, monkeypatch, short):
    """Also within a family of many, one with a subfamily, one without its base, a chain, and with all differences long."""
    monkeypatch.setattr(jaccard_join, "SHORT", short)
    monkeypatch.setattr(jaccard_join, "HOLDERS", 8)
    rng = random.Random(11)
    texts = dict(family)
    base, other = prose(rng, 200).split(), prose(rng, 90).split()
    sub = base[:60] + [f"sub{i}" for i in range(12)] + base[72:]
    chain = prose(rng, 100).split()
    many = [_edited(rng, base, 6, 3) for _ in range(250)] + [_edited(rng, sub, 4, 10**6) for _ in range(60)]
    many += [_edited(rng, [*other[:40], f"own{i % 3}", *other[41:]], 3, 2) for i in range(80)]
    many += [" ".join(chain[k : k + 60]) for k in range(0, 40, 3)]
    texts |= {1000 + i: t for i, t in enumerate(many)}
    got = {r.doc_id: r.n_links for r in jaccard_join.join(texts_of(spark, texts.items())).collect()}
    assert got == _all_links(texts)


def test_jaccard_keeps_one(spark, family, odd):
    df = texts_of(spark, family + family[:3])
    kept = [r.doc_id for r in jaccard_join.keep_first(df).collect()]
    want = brute.classes(dict(family))[0]
    assert sorted(kept) == sorted(set(want.values()))
    rest = jaccard_join.keep_first(odd)
    assert rest.columns == odd.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in rest.collect()) == sorted({((i or 0), t or "") for i, t in ODD})
    assert jaccard_join.join(df.limit(0)).count() == 0


def test_depths_reach_the_target():
    lengths = jaccard_join.depths()
    assert lengths[0] == jaccard_join.DEPTH and jaccard_join.recall(lengths[-1], 0.8) >= jaccard_join.RECALL
    assert all(jaccard_join.recall(n, 0.8) < jaccard_join.RECALL for n in lengths[:-1])


def test_gam_learns_and_scores(spark, sf, odd):
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    again = quality_gam.classify(odd, labels).collect()
    assert len(again) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in again)
    assert all(r.held_out == (r.doc_id is not None and brute.crc(r.doc_id) % 4 == 2) for r in again)
    model = quality_gam.train(docs, labels.filter("quality is null"))
    assert not model.trained and quality_gam.keep_good(docs, labels.limit(0)).count() == docs.count()
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.02)).astype(float)  # no feature tells anything alone
    model = quality_gam.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.85


def test_gam_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = queries.op5_quality_gam(spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").filter("held_out").collect()
    assert len(scored) > 50 and np.mean([r.predicted == r.quality for r in scored]) >= 0.95


def test_line_features():
    rng = random.Random(3)
    for _ in range(60):
        texts = ["".join(rng.choice("ab \n\t|") for _ in range(rng.randrange(30))) if rng.random() > 0.2 else None for _ in range(6)]
        for t, row in zip(texts, features.measure(pa.array(texts, pa.string())), strict=True):
            lines = [x for x in (t or "").split("\n") if x.strip(" \t")]
            assert abs(row[features.NAMES.index("repeated_lines")] - (1 - len(set(lines)) / len(lines) if lines else 0)) < 1e-9


def test_sharding(spark, odd):
    rng = random.Random(4)
    pairs = [(i, prose(rng, rng.randrange(1, 30)) if i % 3 else "the same text in a third of all rows") for i in range(3000)]
    got = sharding.assign(texts_of(spark, pairs), 8).toPandas()
    assert len(got) == 3000 and (got.law == "bytes").all() and got.grown_shard.isna().all()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)
    want = {i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs}
    assert {r.doc_id: (r.size_, r.text_crc32) for r in got.rename(columns={"size": "size_"}).itertuples()} == want
    assert sharding.assign(odd).count() == len(ODD) and sharding.assign(odd.limit(0)).count() == 0


def test_sharding_writes_whole_records(spark, odd, tmp_path):
    back = sharding.write_shards(odd, str(tmp_path / "shards"), 3)
    assert sorted((r.document.doc_id or 0, r.document.text or "") for r in back.collect()) == sorted(((i or 0), t or "") for i, t in ODD)


def test_rule_counts(spark):
    rng = random.Random(5)
    pairs = [(i, "".join(rng.choice(["a ", "b ", "c\n", "é#", "\t", "  ", "a\n"]) for _ in range(rng.randrange(80)))) for i in range(300)]
    pairs += [(1000 + i, t) for i, (_, t) in enumerate(ODD)]
    got = {r.doc_id: r for r in quality_rules.judge(texts_of(spark, pairs)).collect()}
    for i, t in pairs:
        r, want = got[i], brute.rule_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)


def test_rules_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op7_quality_rules(spark, folder).join(queries.table(spark, folder, "labels"), "doc_id").filter("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
    assert quality_rules.judge(queries.table(spark, folder, "documents").limit(0)).count() == 0


def test_leaks(spark, odd):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randrange(5, 70))) for i in range(30)] + [(90, "too short"), (91, None), (None, prose(rng, 12)), (92, prose(rng, 300))]
    pairs = []
    for i in range(120):
        parts = [prose(rng, rng.randrange(0, 800)), prose(rng, rng.randrange(0, 800))]
        w = (rng.choice(items)[1] or "").split()
        if w and i % 3 == 0:
            w[rng.randrange(len(w))] = "changed"
        pairs.append((i, " ".join([parts[0], *w[: len(w) // 2], *([parts[1]] if i % 5 == 0 else []), *w[len(w) // 2 :], parts[1]])))
    df, bench = texts_of(spark, pairs + ODD[:1]), spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in pairs:
        own = brute.shingles(t)
        for i, q in items:
            s = brute.shingles(q) if len(brute.words(q)) >= 5 else set()
            if s and len(s & own) >= 0.8 * len(s):
                want.add((i, d, len(s), len(s & own)))
    got = {(r.item_id, r.doc_id, r.n_shingles, r.n_shared) for r in decontaminate.find_leaks(df, bench).collect()}
    assert got == want and len(want) > 50
    kept = {r.doc_id for r in decontaminate.drop_leaking(df, bench).collect()}
    assert kept == {d for d, _ in pairs} - {d for _, d, _, _ in want} | {1}
    assert decontaminate.drop_leaking(odd, bench).count() == len(ODD) and decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def test_items_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, 20)) for i in range(20)]
    df, bench = texts_of(spark, [(i, f"x {t} y") for i, t in items]), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 700)
    assert sorted((r.item_id, r.doc_id) for r in decontaminate.find_leaks(df, bench).collect()) == [(i, i) for i in range(20)]
    assert decontaminate.drop_leaking(df, bench).count() == 0


def test_token_files(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    rng = random.Random(9)
    bits = ["a", "B", " ", "  ", "\n", " \n", "\t", "é", "\u00a0", "\u3000", " ", "’", "<|endoftext|>", "don't", "12", "日本", "😀", " x", "ing"]
    pairs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(14)))) for i in range(500)] + [(-5, "minus"), (7, "again"), (None, "null")]
    shards = token_store.write(texts_of(spark, pairs), scratch.new_path(spark, "t"), path, shard_bytes=900)
    got = sorted(token_store.read(shards).collect(), key=lambda r: r.start)
    assert shards.count() > 3 and [r.doc_id for r in got] == sorted((i for i, _ in pairs), key=lambda i: (i is not None, i))
    at, by_id = 0, defaultdict(list)
    for i, t in pairs:
        by_id[i].append(np.array(coder.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in {(len(x), zlib.crc32(x.tobytes())) for x in by_id[r.doc_id]}
        at += r.n_tokens
    found = token_store.lookup(shards, spark.range(-10, 600).withColumnRenamed("id", "doc_id")).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in found) == sorted((i, tuple(x.tolist())) for i, xs in by_id.items() if i is not None for x in xs)
    assert token_store.read(token_store.write(texts_of(spark, []), scratch.new_path(spark, "t"), path)).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).choice(2**40, 20_000, replace=False).astype(np.uint64)
    table = token_store.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))


def test_recurrent_scores(spark, odd):
    rng = random.Random(10)
    phrase = "Red blue green , yellow pink . ".split()
    pairs = [(i, " ".join(phrase[(k + i) % 7] if rng.random() > 0.1 else f"rare{rng.randrange(300)}" for k in range(rng.randrange(200)))) for i in range(300)] + ODD
    got = recurrent_lm.score(texts_of(spark, pairs)).collect()
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    tokens = [(i, brute.words(lower(t)) + [None]) for i, t in pairs]
    held = lambda i: i is not None and brute.crc(i) % 5 == 1
    count = Counter(w for i, ws in tokens if not held(i) for w in ws)
    total = sum(count.values())
    base = defaultdict(set)
    for i, ws in tokens:
        base[i].add((len(ws), sum(count[w] > 0 for w in ws), round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in ws), 6)))
    assert len(got) == len(pairs)
    for r in got:
        assert r.held_out == held(r.doc_id) and r.train_tokens == total and (r.n_tokens, r.n_known, round(r.base_score, 6)) in base[r.doc_id]
    assert all(r.score < 0 for r in got)
    assert recurrent_lm.score(odd.limit(0)).count() == 0


def test_recurrent_model_beats_counts_on_held_out_documents(spark):
    out = queries.op10_recurrent_lm(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_network_learns_from_every_training_document(spark):
    """Few documents, none of which a 5 % hash sample drew, still teach the order of their words."""
    drawn = lambda i: W.mix(np.array([i], np.uint64) ^ np.uint64(recurrent_lm.SEED))[0] < np.uint64(int(0.05 * 2**64))
    ids = [i for i in range(400) if not drawn(i)]
    out = recurrent_lm.score(texts_of(spark, [(i, "red blue " * 100) for i in ids]).coalesce(1)).filter("held_out").collect()
    assert len(out) > 50 and all(r.score > 0.5 * r.base_score for r in out)


def test_learning_takes_the_gradient():
    """The first step from a window goes down the loss by the sign of its numeric gradient."""
    classes = np.random.default_rng(3).integers(0, 5, (recurrent_lm.WINDOW, recurrent_lm.STREAMS))
    start = np.random.default_rng(4).normal(0, 0.3, recurrent_lm.Network().values.size).astype(np.float32)

    def loss(values):
        net, total = recurrent_lm.Network(values), 0.0
        state, before = np.zeros((classes.shape[1], recurrent_lm.HIDDEN), np.float32), np.full(classes.shape[1], 1)
        for now in classes:
            state = net.step(state, before)[0]
            total -= net.log_probability(state, now).astype(float).sum()
            before = now
        return total / classes.size

    net = recurrent_lm.Network(start.copy())
    net.learn(classes, 1)
    moved, checked = net.values - start, 0
    for k in np.random.default_rng(5).permutation(len(start))[:400]:
        up, down = start.astype(float), start.astype(float)
        up[k] += 1e-4
        down[k] -= 1e-4
        slope = (loss(up) - loss(down)) / 2e-4
        if abs(slope) > 1e-4:
            checked += 1
            assert np.sign(moved[k]) == -np.sign(slope)
    assert checked > 50


def test_packing():
    values = np.random.default_rng(1).integers(0, 2**20, 5000).astype(np.uint32)
    assert (recurrent_lm.unpack(recurrent_lm.pack(values)) == values).all()


def test_model_is_a_distribution():
    net = recurrent_lm.Network()
    state = net.step(np.zeros((3, recurrent_lm.HIDDEN), np.float32), np.array([0, 1, 2]))[0]
    total = sum(np.exp(net.log_probability(state, np.full(3, k))) for k in range(recurrent_lm.CLASSES))
    assert np.allclose(total, 1, atol=1e-4)
