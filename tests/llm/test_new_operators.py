"""Operators 11 to 13 on nulls, ties, repeats, clashing names, and against plain Python."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, hard_negatives, vector_codes

BLANKS = str.maketrans("", "", " \t\n\x0b\f\r")


def plain_duplicates(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(BLANKS), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


TEXTS = [(5, "a b"), (3, "ab"), (9, "a  b"), (7, "a \tb"), (1, "ab "), (2, None), (4, ""), (6, " \n"), (6, " \n"), (8, "Ab"), (None, "a b c"), (10, "abc"), (11, "😀 x"), (12, "😀x")]


@pytest.mark.parametrize("digest", [F.md5, lambda c: F.substring(F.md5(c), 1, 1), lambda c: F.lit("one")], ids=["md5", "weak", "none"])
def test_exact_duplicates_whatever_the_hash(spark, digest):
    rows = TEXTS + [(100 + i, f"row {i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("key", F.lit(1)).withColumn("hash", F.lit("x"))
    got = exact_dedup.exact_duplicates(df, digest)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_duplicates(rows)
    kept = exact_dedup.deduplicated(df, digest)
    assert kept.columns == df.columns and kept.count() == len({(t or "").translate(BLANKS) for _, t in rows})


def test_exact_duplicates_of_odd_rows(spark, odd):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(odd).collect()}
    assert {(1, 1, 3, True), (2, 1, 3, False), (3, 5, 3, False), (4, 5, 3, False), (5, 5, 3, True), (None, None, 1, True)} <= got
    assert exact_dedup.exact_duplicates(odd).count() == odd.count()
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == 7
    assert exact_dedup.exact_duplicates(odd.limit(0)).count() == exact_dedup.deduplicated(odd.limit(0)).count() == 0


def test_exact_duplicates_use_no_python(spark, documents):
    plan = exact_dedup.exact_duplicates(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def vectors(n, d, seed, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 0.2, (n, d)).astype(np.float32)
    if copies:  # near and exact copies of one vector
        v[:copies] = v[0] + rng.normal(0, 0.002, (copies, d)).astype(np.float32)
        v[: copies // 3] = v[0]
    return v


def plain_codes(ids, v, entries=256, rounds=4, parts=4):
    q = np.floor(1024 * v.astype(float)).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    code, error, books, d = [""] * len(q), np.zeros(len(q), np.int64), [], q.shape[1] // parts
    for p in range(parts):
        x = q[:, p * d : (p + 1) * d]
        book = x[order[:entries]].copy()
        near = lambda x=x: ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        for _ in range(rounds):
            at, new = near().argmin(axis=1), book.copy()
            for e in set(at.tolist()):
                new[e] = x[at == e].sum(axis=0) // (at == e).sum()
            book = new
        dist = near()
        at = dist.argmin(axis=1)
        code = [c + f"{a:02x}" for c, a in zip(code, at, strict=True)]
        error += dist.min(axis=1)
        books.append(book)
    return code, error.tolist(), hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()


@pytest.mark.parametrize("n,d,copies", [(1500, 16, 600), (100, 8, 0), (700, 4, 0), (40, 64, 40)])
def test_codes_are_those_of_plain_rounds(spark, n, d, copies):
    v = vectors(n, d, n, copies)
    ids = np.random.default_rng(1).permutation(n) * 3
    df = spark.createDataFrame([(int(i), x.tolist(), int(i) % 3 or None) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<float>, label int")
    got, books = vector_codes.codes(df.repartition(5))
    rows = {r.vec_id: r for r in got.collect()}
    code, error, mark = plain_codes(ids, v)
    assert [rows[i].code for i in ids.tolist()] == code and [rows[i].error for i in ids.tolist()] == error
    totals = {}
    for i, e in zip(ids.tolist(), error, strict=True):
        totals[i % 3] = totals.get(i % 3, 0) + e
    assert all(rows[i].label_error == totals[i % 3] and rows[i].codebooks_sha256 == mark for i in ids.tolist())
    assert set(books) == {(d, p) for p in range(4)}


def test_blocks_leave_out_entries_without_changing_the_result():
    rng = np.random.default_rng(5)
    book = rng.integers(-500, 500, (256, 4))
    for spread in (0, 3, 60):
        values = rng.integers(-400, 400, 4) + rng.integers(-spread, spread + 1, (64, 4))
        some = vector_codes.shortlist(values.min(axis=0), values.max(axis=0), book)
        at, d = vector_codes.nearest(values, book, some)
        whole = ((values[:, None] - book[None]) ** 2).sum(axis=2)
        assert (at == whole.argmin(axis=1)).all() and (d == whole.min(axis=1)).all()
        assert len(some) < (4, 20, 256)[(0, 3, 60).index(spread)]


def test_hilbert_curve_visits_each_cell_once_by_single_steps():
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        place = vector_codes.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_codes_with_large_numbers_are_exact():
    values = np.array([[1 << 31, 3], [-(1 << 31), 5], [(1 << 31) + 1, 3]], dtype=np.int64)
    at, d = vector_codes.nearest(values, values[:2], np.array([0, 1]))
    assert at.tolist() == [0, 1, 0] and [int(x) for x in d] == [0, 0, 1]


ODD = [(0, [1.0, 2.0, 3.0, 4.0], 1), (200, [1.0, 2.0, 3.0, 4.0], 1), (1, [1.0, 2.0, 3.0, 4.0], 2), (1, [1.0, 2.0, 3.0, 4.0], 2)]
ODD += [(2, None, 1), (3, [1.0, None, 2.0, 1.0], 1), (4, [float("nan")] * 4, 1), (5, [float("inf")] * 4, 1), (6, [], 1), (8, [0.5] * 6, 1), (None, [1.0, 2.0, 3.0, 3.0], None), (9, [0.0] * 4, 2)]


def odd_vectors(spark):
    rows = [(*r, 1, "x", 2) for r in ODD]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, row int, q string, dim int")


def test_codes_of_odd_rows(spark):
    got = vector_codes.codes(odd_vectors(spark))[0].collect()
    assert sorted((r.vec_id is None, r.vec_id) if r.vec_id is not None else (True, 0) for r in got) == [(False, 0), (False, 1), (False, 1), (False, 6), (False, 8), (False, 9), (False, 200), (True, 0)]
    assert all(r.error == 0 and len(r.code) == 8 for r in got)
    assert {r.code for r in got if r.vec_id in (0, 1, 200)} == {"00000000"}
    assert vector_codes.codes(odd_vectors(spark).limit(0))[0].count() == 0


def plain_negatives(rows, anchors):
    keep = [(i, np.floor(256 * np.array(x, dtype=float)).astype(object), str(lab)) for i, x, lab in rows]
    out = []
    for at, (a, q, lab) in enumerate(keep):
        if a not in anchors:
            continue
        others = sorted(((-int(sum(q * x)), i, other) for j, (i, x, other) in enumerate(keep) if j != at and len(x) == len(q)), key=lambda t: t[:2])
        for score, i, _ in [o for o in others if o[2] == lab][:5]:
            fit = [o for o in others if o[2] != lab and 80 * -score <= 100 * -o[0] <= 100 * -score][:5]
            out += [(a, i, rank, n, -score, -s) for rank, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("leaf,shard", [(48, 2048), (4, 150), (1, 1000)])
def test_hard_negatives_are_those_of_a_full_scan(spark, monkeypatch, leaf, shard):
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    monkeypatch.setattr(hard_negatives, "SHARD", shard)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    v = vectors(800, 6, 4, 300)
    rows = [(i, x.tolist(), int(i * 7919 % 5)) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())
    assert got == plain_negatives(rows, set(range(0, 800, 50))) and len(got) > 300


def test_a_tree_covers_what_it_holds_and_parts_its_centres():
    points = hard_negatives.augmented(np.floor(256 * vectors(1500, 5, 9, 500)).astype(np.int64))
    assert np.allclose((points**2).sum(axis=1), (points**2).sum(axis=1)[0])
    tree = hard_negatives.build(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for i in range(len(tree.start)):
        d = np.sqrt(((points[tree.order[tree.start[i] : tree.stop[i]]] - points[tree.center[i]]) ** 2).sum(axis=1))
        assert d.max() <= tree.radius[i] * (1 + 1e-9) + 1e-9
        kids = slice(tree.first[i], tree.last[i])
        if tree.first[i] < tree.last[i]:
            assert tree.start[kids][0] == tree.start[i] and tree.stop[kids][-1] == tree.stop[i]
            assert tree.radius[kids].max() <= tree.radius[i] / hard_negatives.BASE * (1 + 1e-6) + 1e-3


def test_descent_skips_most_of_clustered_vectors():
    rng = np.random.default_rng(2)
    v = (rng.normal(0, 60, (40, 8))[rng.integers(0, 40, 2000)] + rng.normal(0, 2, (2000, 8))).astype(np.int64)
    shard = hard_negatives.Shard(v, np.arange(2000), np.arange(2000), ["a"] * 2000, hard_negatives.build(hard_negatives.augmented(v)))
    seen = []
    plain = shard.scores
    shard.scores = lambda query, places: seen.append(len(places)) or plain(query, places)
    for i in range(20):
        best = shard.search(v[i], -1, "b", False, [(-(1 << 63), (1 << 63) - 1)], 5)[0]
        s = v @ v[i]
        assert [p for _, p in best] == np.lexsort((np.arange(2000), -s))[:5].tolist()
    assert sum(seen) < 20 * 2000 / 3


def test_hard_negatives_of_odd_rows(spark):
    got = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in hard_negatives.hard_negatives(odd_vectors(spark), F.col("vec_id") % 100 == 0).collect())
    score = 256 * 256 * 30
    assert got == [(a, p, rank, 1, score, score) for a, p in ((0, 200), (200, 0)) for rank in (1, 2)]
    empty = hard_negatives.hard_negatives(odd_vectors(spark).limit(0), F.col("vec_id") % 100 == 0)
    assert empty.count() == 0 and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
