import os
import random
import struct
import uuid
import zlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pageloom.functions import hashes as hs
from pageloom.operators import dedup as dd
from pageloom.operators import embed as em
from pageloom.sources import images as im
from pageloom.sources import sinks, tables


def _apart(a, b):
    return sum(x != y for x, y in zip(a, b))


def _one_by_one(items, t):
    """Group of each item by going through them in order."""
    leaders, out = [], {}
    for ord_, p, a in sorted(items):
        near = [o for o, lp, la in leaders if _apart(p, lp) <= t and _apart(a, la) <= t]
        out[ord_] = near[0] if near else ord_
        if not near:
            leaders.append((ord_, p, a))
    return out


def _change(rng, text, n):
    chars = list(text)
    for i in rng.sample(range(16), n):
        chars[i] = rng.choice("0123456789abcdef")
    return "".join(chars)


def _items(seed, n, t):
    """Clusters, chains, exact copies and loners, in mixed order."""
    rng = random.Random(seed)
    draw = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(16))
    pool = [(draw(), draw()) for _ in range(4)]
    while len(pool) < n:
        p, a = rng.choice(pool)
        kind = rng.random()
        if kind < 0.2:
            pool.append((draw(), draw()))
        elif kind < 0.35:
            pool.append((p, a))
        elif kind < 0.45:
            pool.append((_change(rng, p, min(t, 15) // 2), draw()))
        else:
            pool.append((_change(rng, p, min(t + 1, 16)), _change(rng, a, min(t, 16))))
    rng.shuffle(pool)
    return [(i, p, a) for i, (p, a) in enumerate(pool)]


@pytest.mark.parametrize("t,slice_size", [(0, 100), (1, 1000), (3, 200), (5, 25), (9, 200), (12, 200)])
def test_leader_groups_equal_one_by_one(spark, t, slice_size, monkeypatch):
    monkeypatch.setattr(dd, "SMALLEST_SLICE", 10)
    items = _items(t * 7 + slice_size, 160, t)
    df = spark.createDataFrame(items, "ord long, phash string, ahash string")
    got = dd.leader_groups(df, t, slice_size).collect()
    want = _one_by_one(items, t)
    assert {r.ord: r.leader_ord for r in got} == want
    order = {lead: i for i, lead in enumerate(sorted(set(want.values())), 1)}
    assert all(r.group_no == order[r.leader_ord] for r in got)


def test_slices_shrink_when_a_slice_is_costly(spark, monkeypatch):
    monkeypatch.setattr(dd, "SMALLEST_SLICE", 10)
    monkeypatch.setattr(dd, "PAIR_BUDGET", 50)
    monkeypatch.setattr(dd, "PAIRS_PER_ITEM", 1)
    items = _items(11, 120, 5)
    df = spark.createDataFrame(items, "ord long, phash string, ahash string")
    assert {r.ord: r.leader_ord for r in dd.leader_groups(df, 5, 120).collect()} == _one_by_one(items, 5)


def test_threshold_of_all_characters_gives_one_group(spark):
    items = _items(3, 30, 5)
    df = spark.createDataFrame(items, "ord long, phash string, ahash string")
    assert rows(dd.leader_groups(df, 16).select("leader_ord", "group_no").distinct()) == [(0, 1)]


@pytest.mark.parametrize("t", [0, 5, 15])
def test_similar_pairs_equal_brute_force(spark, t):
    items = _items(t, 90, t)
    df = spark.createDataFrame(items, "ord long, phash string, ahash string")
    leaders = df.filter("ord % 3 = 0").dropDuplicates(["phash", "ahash"])
    lead = [(r.ord, r.phash, r.ahash) for r in leaders.collect()]
    leaders = spark.createDataFrame(lead, "ord long, phash string, ahash string")
    want = {(o, lo) for o, p, a in items for lo, lp, la in lead if _apart(p, lp) <= t and _apart(a, la) <= t}
    got = dd.similar_pairs(df, leaders, t).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("equal", ["ahash", "phash"])
def test_images_of_one_hash_are_told_apart_by_the_other(spark, equal):
    """Items that share one of their hashes have few candidates."""
    other = "phash" if equal == "ahash" else "ahash"
    items = spark.range(40_000 if equal == "ahash" else 5_000).select(F.col("id").alias("n"), F.lit("00ff00ff00ff00ff").alias(equal), F.substring(F.md5(F.col("id").cast("string")), 1, 16).alias(other))
    items = dd.hashed(items)
    sizes = dd._keyed(items, dd._crowded(items, 5), 5).groupBy("kind", "key", "a_kind", "a_key").agg(F.count("*").alias("c"))
    assert sizes.agg(F.expr("sum(cast(c as double) * (c - 1) / 2)")).first()[0] < 400_000
    own = sizes.groupBy("a_kind").agg(F.expr("sum(c * (c - 1) / 2)").alias("pairs"))
    assert equal == "phash" or own.first()["pairs"] < 100_000


def test_crowded_keys_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(dd, "CROWDED", 3)
    monkeypatch.setattr(dd, "SMALLEST_SLICE", 10)
    for t in (5,):
        items = _items(t + 50, 120, t)
        df = spark.createDataFrame(items, "ord long, phash string, ahash string")
        assert {r.ord: r.leader_ord for r in dd.leader_groups(df, t, 60).collect()} == _one_by_one(items, t)


def test_masks_cover_every_difference():
    rng = random.Random(5)
    for t in range(16):
        masks = dd._cover(t)
        assert len(masks) <= dd.MOST_KEYS
        for _ in range(200):
            x = sum(rng.randrange(1, 16) << 4 * k for k in rng.sample(range(16), t))
            assert any(m & x == 0 for m in masks)


def test_similarity_join_has_no_nested_loop(spark):
    df = spark.createDataFrame(_items(1, 20, 5), "ord long, phash string, ahash string")
    plan = dd.similar_pairs(df, df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_distances(spark):
    pairs = [("0000000000000000", "000000000000000f"), ("ffffffffffffffff", "0fffffffffffffff"), ("8000000000000001", "8000000000000001")]
    df = spark.createDataFrame(pairs, "a string, b string")
    a, b = F.col("a"), F.col("b")
    assert rows(df.select(hs.hex_distance(a, b), hs.bit_distance(a, b))) == [(0, 0), (1, 4), (1, 4)]


def test_dedup_keeps_the_largest_and_reports(spark):
    sizes = [60255, 41000, 39000, 30000, 20000, 60255]
    data = [(i, "0" * 16, "f" * 16, s, 770 - i, 513) for i, s in enumerate(sizes)] + [(6, "a" * 16, "5" * 16, 9, 1, 2)]
    df = spark.createDataFrame(data, "ord long, phash string, ahash string, size_bytes long, width int, height int")
    got = dd.dedup(df)
    first = got.filter("group_no = 1").orderBy("rank").collect()
    assert [r.ord for r in first] == [0, 1, 2, 3, 4, 5]
    assert [r.action for r in first] == ["Retained"] + ["Deleted"] * 5
    assert (round(first[0].size_kb, 2), first[0].dims) == (58.84, "770x513")
    assert rows(dd.dedup_summary(got)) == [(1, 6, 0, 5, 60255, sum(sizes) - 60255), (2, 1, 6, 0, 9, 0)]


def _png(path, width, height, value):
    raw = b"".join(b"\x00" + bytes(value(x, y) for x in range(width) for _ in range(3)) for y in range(height))
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
                     + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    wave = lambda s: lambda x, y: (x * 5 // s + y * 3 // s + (x // s) * (y // s) // 7) % 256
    _png(root / "a.png", 64, 64, wave(1))
    _png(root / "b.PNG", 128, 128, wave(2))
    _png(root / "c.png", 64, 64, lambda x, y: 255 if (x // 8 + y // 8) % 2 else 0)
    (root / "broken.jpg").write_bytes(b"not an image")
    (root / "d.webp").write_bytes(b"RIFF")
    (root / "notes.txt").write_text("x")
    (root / ".jpg").write_text("x")
    return root


def test_image_files(spark, folder):
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names(im.scan_images(spark, str(folder))) == ["a.png", "b.PNG", "broken.jpg", "c.png"]
    assert names(im.scan_images_ext(spark, str(folder))) == ["a.png", "b.PNG", "broken.jpg", "c.png", "d.webp"]
    assert names(im.broken(im.decoded(spark, str(folder)))) == ["broken.jpg"]


def test_scaled_copy_is_a_duplicate(spark, folder):
    items = im.image_items(spark, str(folder)).withColumn(
        "ord", F.when(F.col("path").endswith("a.png"), 0).when(F.col("path").endswith("b.PNG"), 1).otherwise(2).cast("long"))
    got = dd.dedup(items).orderBy("ord").collect()
    assert [(r.ord, r.group_no) for r in got] == [(0, 1), (1, 1), (2, 2)]
    assert {r.dims for r in got} == {"64x64", "128x128"}


def test_folder_in_one_call(spark, folder):
    (folder / "empty.png").write_bytes(b"")  # Spark's readers pass over it
    done = im.dedup_folder(spark, str(folder))
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    size = lambda n: (folder / n).stat().st_size
    best, other = ("b.PNG", "a.png") if size("b.PNG") > size("a.png") else ("a.png", "b.PNG")
    assert names(done.keep) == sorted([best, "c.png"]) and names(done.drop) == [other]
    got = [(r.ord, r.group_no, r.path.rsplit("/", 1)[1]) for r in done.groups.orderBy("ord").collect()]
    assert got == [(1, 1, "a.png"), (2, 1, "b.PNG"), (3, 2, "c.png")]
    reasons = {r.path.rsplit("/", 1)[1]: r.reason for r in done.rejects.collect()}
    assert reasons == {"broken.jpg": "not a readable image"}


def test_folder_without_images(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    done = im.dedup_folder(spark, str(tmp_path))
    assert [df.count() for df in (done.keep, done.drop, done.groups, done.rejects)] == [0, 0, 0, 0]


def test_inference_batches_rejects_and_sinks(spark, tmp_path):
    def model(batch):
        assert len(batch) <= 3
        if "bad" in batch:
            raise RuntimeError("cannot read")
        return [[[float(len(x)), 0.5]] * (len(x) % 3) for x in batch]

    df = spark.createDataFrame([(f"i{k}", c) for k, c in enumerate(["a", "bb", "bad", "ccc", "dddd"])], "image_path string, content string").coalesce(1)
    done = em.embed_images(df, model, 3)
    assert rows(em.rejected_images(done)) == [("i2", "RuntimeError: cannot read")]
    faces = em.explode_faces(done)
    assert rows(faces.select("image_path", "face_index")) == [("i0", 0), ("i1", 0), ("i1", 1), ("i4", 0)]
    assert rows(em.face_counts(faces)) == [("i0", 1, 1), ("i1", 2, 1), ("i4", 1, 1), (None, 4, 3)]
    path = str(tmp_path / "v")
    assert sinks.sink_embeddings(faces, path)
    back = em.embedding_array(tables.read_table(spark, path, "image_path string, face_index int, embedding string", "csv"))
    assert rows(back) == rows(faces)
    assert not sinks.sink_embeddings(faces.limit(0), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        em.embed_images(df, model, 0)
    with pytest.raises(ValueError):
        em.embed_images(df)
    with pytest.raises(ValueError):
        em.embed_images(df, model, load_model=lambda: model)


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    """Several tasks and frames: one load for each worker process, whole batches across frames, whole vectors."""
    folder = str(tmp_path)

    def load():
        with open(f"{folder}/load-{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass

        def model(batch):
            with open(f"{folder}/batch-{len(batch)}-{uuid.uuid4().hex}", "w"):
                pass
            return [[[float(x), float(x) / 4, -1.0]] for x in batch]

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        df = spark.range(0, 60, 1, 3).selectExpr("cast(id as string) as image_path", "id as content")
        got = rows(em.embed_images(df, batch_size=10, load_model=load))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted((str(k), [[float(k), k / 4, -1.0]], None) for k in range(60))
    made = [n.split("-") for n in os.listdir(folder)]
    loads = [n[1] for n in made if n[0] == "load"]
    assert loads and len(loads) == len(set(loads))
    assert [n[1] for n in made if n[0] == "batch"] == ["10"] * 6
