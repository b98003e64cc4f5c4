"""Substring dedup by word windows, importance resampling and centroid clustering: brute force, odd rows and borders."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retentia.llm import centroids, resampling, wordwindows
from retentia.llm.common import matched, numbered

CLASHING = "doc_id long, text string, row int, place int, digest string, kept string, score double, rank int, n_words int, runs int, copy int"


def words(seed, n, of=200):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, of)}" + "é" * (seed % 2) for _ in range(n)]


def clashing(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, "x", "y", 0.5, 3, 4, 5, 6) for i, t in texts], CLASHING)


def kept_by_brute_force(texts, length):
    """texts: (key, text) with non-null keys; kept words and number of removed ones per row."""
    first, split = {}, [(k, (t or "").split()) for k, t in texts]
    for k, w in split:
        for i in range(len(w) - length + 1):
            s = tuple(w[i : i + length])
            first[s] = min(k, first.get(s, k))
    out = []
    for k, w in split:
        gone = {p for i in range(len(w) - length + 1) if first[tuple(w[i : i + length])] < k for p in range(i, i + length)}
        out.append((k, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out)


def words_of(kept):
    return " ".join(bytes(kept).decode().split())


def removed(df, settings=wordwindows.WindowSettings()):
    out = wordwindows.remove_repeated_windows(df, settings=settings).collect()
    assert all(r["kept_sha256"] == hashlib.sha256(words_of(r["kept"]).encode()).hexdigest() for r in out)
    assert all(bytes(r["kept"]).decode() == (r["row"]["text"] or "") for r in out if not r["n_removed"])
    return [(r["row"]["doc_id"], r["n_words"], r["n_removed"], words_of(r["kept"])) for r in out]


def test_least_of_every_stretch():
    x = np.array([5, 3, 9, 1, 7, 2, 8], np.uint64)
    for w in range(1, 8):
        assert wordwindows._least(x, w).tolist() == [min(x[i : i + w]) for i in range(8 - w)]


def test_windows_against_brute_force(spark):
    rng = random.Random(4)
    shared = [words(100 + i, 30) for i in range(4)]
    texts = []
    for i in range(60):
        body = words(i, rng.randint(0, 25)) + rng.choice(shared)[rng.randint(0, 8) : rng.randint(15, 30)] + words(50 + i, rng.randint(0, 20))
        texts.append((rng.randint(0, 50), rng.choice([" ", "\n", " \t"]).join(body)))
    texts += [(7, ""), (8, None), (9, " \n "), (60, texts[0][1]), (61, texts[0][1]), (61, texts[0][1]), (62, texts[0][1].upper())]
    for settings in (wordwindows.WindowSettings(10, 4), wordwindows.WindowSettings(10, 10), wordwindows.WindowSettings(7, 1)):
        assert sorted(removed(clashing(spark, texts), settings)) == kept_by_brute_force(texts, settings.length)


def test_windows_of_copies_null_keys_and_empty_tables(spark):
    text = " ".join(words(1, 80))
    docs = clashing(spark, [(None, text), (3, text), (3, text), (5, text), (None, "x " + text), (4, " ".join(words(3, 49))), (6, " ".join(words(3, 49)))])
    out = sorted(removed(docs), key=str)
    assert [r[2] for r in out if r[0] == 3] == [0, 0] and [r[2] for r in out if r[0] == 5] == [80]
    assert sorted(r[2:] for r in out if r[0] is None) == [(80, ""), (80, "x")] and {r[2] for r in out if r[0] in (4, 6)} == {0}
    assert removed(docs.limit(0)) == []
    with pytest.raises(ValueError, match="minimiser"):
        wordwindows.WindowSettings(5, 6)


def test_windows_across_the_pieces_of_long_texts(spark, monkeypatch):
    passage = words(7, 60, of=10**6)
    long = [f"a{i}" for i in range(400_000)]  # several pieces of 1 MB of text
    long[310_000:310_000] = passage
    texts = [(1, " ".join(passage)), (2, " ".join(long)), (3, " ".join(long[:150_000]))]
    out = sorted(removed(clashing(spark, texts)))
    assert [r[:3] for r in out] == [(1, 60, 0), (2, 400_060, 60), (3, 150_000, 150_000)]
    assert out[1][3] == " ".join(f"a{i}" for i in range(400_000))
    whole = wordwindows.super_kmers(np.arange(300, dtype=np.uint64), wordwindows.WindowSettings(20, 5))
    monkeypatch.setattr(wordwindows, "PIECE", 64)
    cut = wordwindows.super_kmers(np.arange(300, dtype=np.uint64), wordwindows.WindowSettings(20, 5))
    windows = [{(w, m) for f, n, m in zip(*x) for w in range(f, f + n)} for x in (whole, cut)]
    assert windows[0] == windows[1] and len(windows[0]) == 281 and len(cut[0]) > len(whole[0])


@pytest.mark.parametrize("few", [0, 10**6])
def test_windows_by_shuffle_and_by_broadcast(spark, monkeypatch, few):
    """A passage in most documents, between words of their own: one bucket holds them all."""
    monkeypatch.setattr(wordwindows, "FEW", few)
    monkeypatch.setattr(wordwindows, "matched", lambda rows, keys, on, few: matched(rows, keys, on, few, heavy=100))
    passage = words(3, 60)
    texts = [(i, " ".join(words(i, 10) + (passage if i % 3 else words(1000 + i, 60)) + words(i + 500, 10))) for i in range(400)]
    assert sorted(removed(clashing(spark, texts))) == kept_by_brute_force(texts, 50)


def test_stored_tables_hold_places_and_digests_only(spark, monkeypatch):
    """Packed strings overlap: written out they are larger than the texts, in every task's memory as well."""
    stored, write = {}, wordwindows.written

    def recorded(df, name):
        stored[name] = {f.name for f in df.schema if f.dataType.simpleString() in ("binary", "string")}
        return write(df, name)

    monkeypatch.setattr(wordwindows, "written", recorded)
    passage = words(3, 70)
    texts = [(i, " ".join(words(i, 10) + passage + words(i + 500, 10 + i))) for i in range(30)]
    assert sorted(removed(clashing(spark, texts))) == kept_by_brute_force(texts, 50)
    assert {"minimisers", "owned", "strings", "windows"} <= set(stored) and set().union(*stored.values()) == {"digest"}


def drawn_by_brute_force(docs, target, settings):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(w[i : i + n]) for n in range(1, settings.grams + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % settings.buckets for r in runs]

    s, t = Counter(b for _, x in docs for b in features(x)[1]), Counter(b for x in target for b in features(x)[1])
    S, T, k = sum(s.values()), sum(t.values()), settings.buckets
    out = []
    for i, text in docs:
        n, found = features(text)
        weight = sum(math.floor(settings.scale * math.log((t[b] + 1) * (S + k) / ((s[b] + 1) * (T + k)))) for b in found)
        h = int(hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-settings.scale * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((-r[4], r[0] is None, r[0] or 0) for r in out if r[1] >= settings.least_words)
    return sorted(out, key=str), able[: len(able) * settings.share[0] // settings.share[1]]


@pytest.mark.parametrize("grams", [1, 3])
def test_resampling_against_brute_force(spark, grams):
    rng = random.Random(grams)
    docs = [(i, " ".join(rng.choice(["Alpha", "beta-gamma", "ÉTÉ", "x9", "it's", f"w{rng.randint(0, 50)}"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " 42 !"), (None, docs[1][1]), (5, docs[5][1]), (5, docs[5][1]), *[(7, docs[7][1])] * 40]
    settings = resampling.ResamplingSettings(buckets=97, grams=grams, least_words=5, share=(1, 3))
    target = spark.createDataFrame([("alpha w1 w2 w3",), (None,), ("W1 été x",)], "text string")
    want, drawn = drawn_by_brute_force(docs, ["alpha w1 w2 w3", None, "W1 été x"], settings)
    frame = clashing(spark, docs)
    out = resampling.resample(frame, target, settings=settings).collect()
    assert sorted(((r["row"]["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in out), key=str) == want
    ranked = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r["score"], r["row"]["doc_id"] is None, r["row"]["doc_id"] or 0) for r in ranked] == drawn
    assert resampling.sampled(frame, target, settings).columns == frame.columns
    assert resampling.resample(frame.limit(0), target, settings=settings).count() == 0
    assert resampling.resample(frame, target.limit(0), settings=settings).where("rank is not null").count() == len(drawn)
    nothing = resampling.ResamplingSettings(share=(0, 1), least_words=0)
    assert resampling.resample(frame, target, settings=nothing).where("rank is not null").count() == 0
    everything = resampling.ResamplingSettings(share=(1, 1), least_words=0)
    assert resampling.resample(frame, target, settings=everything).where("rank is not null").count() == len(docs)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    """With a very coarse sketch the first bracket need not hold the cutoff; the result stays exact. Half of the scores are equal."""
    monkeypatch.setattr(resampling, "ACCURACY", 10**6)
    monkeypatch.setattr(resampling.F, "percentile_approx", lambda c, p, a: F.array(F.min(c) + 5, F.min(c) + 10))
    able = spark.createDataFrame([(0 if i % 2 else i, i // 2, i) for i in range(200)], "score long, key long, place long")
    want = sorted(able.collect(), key=lambda r: (-r["score"], r["key"], r["place"]))
    for share in ((1, 10), (1, 2), (7, 10), (1, 1)):
        last = resampling._cutoff(able, share)
        assert last["place"] == want[200 * share[0] // share[1] - 1]["place"]


def test_words_of_long_texts_are_not_cut(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 7)
    text = b"one Twenty-five sixsixsixsixsix, a b c  " * 3
    found = [w for part in resampling._words(text) for w in part]
    assert found == re.findall(rb"[a-z]+", text.lower())
    three = resampling.ResamplingSettings(grams=3)
    piecewise = np.sort(np.concatenate([b for _, b in resampling._buckets(text, three)]))
    monkeypatch.undo()
    assert (piecewise == np.sort(np.concatenate([b for _, b in resampling._buckets(text, three)]))).all()


def test_numbers_follow_the_order(spark):
    rows = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(7)).alias("a"), "id")
    out = numbered(rows, [F.desc("a"), F.col("id")], "number", "test-numbers").collect()
    assert [r["number"] for r in sorted(out, key=lambda r: (-r["a"], r["id"]))] == list(range(1, 1001))
    assert numbered(rows.limit(0), [F.col("id")], "number", "test-numbers").count() == 0


def clusters_by_brute_force(rows, settings):
    kept = [(i, [math.floor(settings.scale * x) for x in v]) for i, v in rows if v and len(v) == settings.size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in order[: settings.clusters]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(settings.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centers = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centers)]
    ends = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = Counter()
    for _, n, d in ends:
        inertia[n] += d
    return sorted([(i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, n, d in ends], key=str)


def test_clusters_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(i % 3, 0.6) for _ in range(5)]) for i in range(500)]
    rows += [(i, [0.25, 0.5, -0.5, 0.0, 1.0]) for i in range(600, 900)]  # copies
    rows += [(1000, None), (1001, []), (1002, [0.1] * 4), (1003, [0.1, None, 0.2, 0.3, 0.4]), (1004, [math.nan] * 5), (1005, [math.inf] * 5)]
    rows += [(None, [0.1] * 5), (7, [3.0] * 5), (7, [3.0] * 5)]
    table = spark.createDataFrame([(i, v, 1, "x", 2, 0.5) for i, v in rows], "vec_id long, embedding array<double>, cluster int, values string, place int, distance double")
    for settings in (centroids.ClusterSettings(size=5, block=16, curve=(3, 5)), centroids.ClusterSettings(clusters=3, rounds=0, size=5), centroids.ClusterSettings(clusters=2000, rounds=2, size=5)):
        out = centroids.cluster_vectors(table, settings=settings).collect()
        got = [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in out]
        assert sorted(got, key=str) == clusters_by_brute_force(rows, settings)
    assert centroids.cluster_vectors(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="beyond"):
        centroids.cluster_vectors(table.limit(1).withColumn("embedding", F.array(*[F.lit(1e9)] * 64)))


def test_boxes_leave_out_far_centroids_only(spark):
    rng = np.random.default_rng(2)
    low = rng.integers(-50, 50, 4)
    values, centers = low + rng.integers(0, 20, (300, 4)), rng.integers(-80, 80, (12, 4))
    some = centroids.candidates(values.min(axis=0), values.max(axis=0), centers)
    assert set(centroids.nearest(values, centers, np.arange(12))[0]) <= set(some) and len(some) < 12
    # Well parted groups: far fewer pairs are compared than there are.
    settings = centroids.ClusterSettings(clusters=8, size=4, block=32, curve=(4, 8))
    spots = [[10.0 * (c >> a & 1) for a in range(4)] for c in range(8)]
    table = spark.createDataFrame([(i, [x + float(rng.normal(0, 0.1)) for x in spots[i % 8]]) for i in range(4000)], "vec_id long, embedding array<double>")
    vectors = centroids.whole_vectors(table, "vec_id", "embedding", settings)
    shares = centroids.fit(centroids.stored_blocks(vectors, settings), np.array(spots, np.int64) * 1024, settings)[1]
    assert len(shares) == 10 and shares[-1] < 0.3


def test_the_curve_visits_every_cell_once_by_steps_of_one():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        place = centroids.hilbert(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        path = cells[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
