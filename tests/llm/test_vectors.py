"""Hard negatives and vector codes against plain versions: nulls, non-finite and odd-length vectors, ties, repeats, clashing names, empty tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from policylens.llm import hard_negatives, pq_codes

NAMES = ("akey", "ints", "block", "code", "sums")  # names that the operators use inside
SCHEMA = "vec_id long, embedding array<float>, label int, " + ", ".join(f"{n} string" for n in NAMES)


def f32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    out = [(k, [r.gauss(0.4, 0.5) for _ in range(16)], r.randrange(3)) for k in range(-40, 300)]
    same = [0.5] * 16
    out += [(400 + k, same, k % 3) for k in range(30)]  # ties
    out += [(200, [0.3] * 16, 1), (200, [0.3] * 16, 1), (200, [0.9] * 16, 2), (500, [0.1] * 16, 0), (500, [0.1] * 16, 0)]  # repeats
    out += [(600, None, 1), (601, [None] * 16, 1), (602, [math.nan] * 16, 1), (603, [math.inf] + same[1:], 1), (604, same, None), (700, same, None)]
    out += [(605, [], 2), (606, [1.0] * 5, 1), (607, [0.25] * 19, 0), (800, [-1.0] * 16, 1), (None, same, 1)]
    return [(i, f32(v), label) for i, v, label in out]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *NAMES) for r in rows], SCHEMA).repartition(3)


def ok(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def negatives(rows):
    ints = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if i is not None and c is not None and ok(v)]
    out = []
    for a, u, la in {(i, tuple(v), c) for i, v, c in ints if i % 100 == 0}:
        scored = [(-sum(x * y for x, y in zip(u, v, strict=False)), i, c) for i, v, c in ints]
        for p, pid, _ in sorted(x for x in scored if x[2] == la and x[1] != a)[:5]:
            inside = sorted(x for x in scored if x[2] != la and 30 * -p <= 100 * -x[0] <= 90 * -p)[:10]
            out += [(a, pid, k + 1, nid, -p, -n) for k, (n, nid, _) in enumerate(inside)]
    return Counter(out)


def mined(df, m=hard_negatives.Mining()):
    return Counter(map(tuple, hard_negatives.mine(df, df["vec_id"], df["embedding"], df["label"], df["vec_id"] % 100 == 0, m).collect()))


@pytest.mark.parametrize("m", [hard_negatives.Mining(), hard_negatives.Mining(shard_values=800, shard_least=1, block=2, tile=(2, 16), leaf=2)])
def test_hard_negatives(spark, rows, m):
    assert mined(frame(spark, rows), m) == negatives(rows)


def test_hard_negatives_of_few_rows(spark):
    assert mined(frame(spark, [])) == Counter()
    assert mined(frame(spark, [(600, None, 1), (100, None, 1)])) == Counter()
    assert mined(frame(spark, [(100, [1.0], 1), (7, [0.5], 2)])) == Counter()  # no positive
    few = [(100, [1.0], 1), (7, [0.5], 2), (8, [1.0], 1), (9, [0.95], 2)]
    assert mined(frame(spark, few)) == negatives(few) == Counter([(100, 8, 1, 7, 65536, 32768)])


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (64, 64, 64), (33, 65, 40), (100, 17, 129)])
def test_strassen_is_exact(shape):
    r = np.random.default_rng(2)
    a, b = r.integers(-2**20, 2**20, shape[:2]), r.integers(-2**20, 2**20, shape[1:])
    for leaf in (1, 4, 32):
        assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()
    big = r.integers(-2**62, 2**62, shape[:2])
    assert (hard_negatives.strassen(big, b, 4) == big @ b).all()  # both modulo 2^64


def test_heaps_merge_in_any_split():
    r = np.random.default_rng(4)
    score, ids = r.integers(0, 6, (5, 60)), np.broadcast_to(np.arange(60), (5, 60))
    for step in (1, 7, 60):
        heaps = hard_negatives.Heaps.empty(5, 8)
        for c in range(0, 60, step):
            heaps.merge(score[:, c:c + step], ids[:, c:c + step], np.ones_like(score[:, c:c + step], bool))
        for k in range(5):
            assert heaps.ids[k].tolist() == sorted(range(60), key=lambda j, k=k: (-score[k, j], j))[:8]


def codes(rows, parts=8, entries=16, rounds=6):
    kept = sorted(((i, v, c) for i, v, c in rows if ok(v)), key=lambda t: (t[0] is None, t[0] or 0, t[2] is not None, str(t[2]), [math.floor(4096 * x) for x in t[1]]))
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in kept]
    width = -(-max(map(len, ints)) // parts)
    x = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[x[k][p] for k in range(min(entries, len(x)))] for p in range(parts)]
    for k in range(rounds + 1):
        near = [[min((sum((a - b) ** 2 for a, b in zip(row[p], e, strict=True)), j) for j, e in enumerate(books[p])) for p in range(parts)] for row in x]
        if k < rounds:
            for p in range(parts):
                for j in range(len(books[p])):
                    mine = [row[p] for row, n in zip(x, near, strict=True) if n[p][1] == j]
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)] if mine else books[p][j]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    error = [sum(d for d, _ in n) for n in near]
    total = Counter()
    for (_, _, c), e in zip(kept, error, strict=True):
        total[c] += e
    return Counter((i, "".join(f"{j:02x}" for _, j in n), e, total[c], sha) for (i, _, c), n, e in zip(kept, near, error, strict=True))


def coded(df, c=pq_codes.Codes()):
    return pq_codes.fit(df, df["vec_id"], df["embedding"], df["label"], c)


def test_codes(spark, rows):
    for c in (pq_codes.Codes(), pq_codes.Codes(batch=7)):
        got = coded(frame(spark, rows), c)
        assert Counter(map(tuple, pq_codes.digests(got).collect())) == codes(rows)
    full = got.scans[0]
    assert all(n <= full for n in got.scans) and got.scans[-1] < full  # rounds look only at what moved


def test_codes_of_few_rows(spark):
    few = [(3, [0.5] * 8, 1), (1, [0.25] * 8, None), (2, [0.25] * 8, None), (4, [float("nan")] * 8, 1)]
    assert Counter(map(tuple, pq_codes.digests(coded(frame(spark, few))).collect())) == codes(few)
    none = pq_codes.digests(coded(frame(spark, few[3:])))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0
    assert pq_codes.digests(coded(frame(spark, []))).count() == 0
    assert pq_codes.digests(coded(frame(spark, [(1, [], 0)]))).first()[1:4] == ("00" * 8, 0, 0)


def test_active_entries_equal_a_full_scan():
    r = np.random.default_rng(6)
    x, book = r.integers(0, 6, (500, 3)), r.integers(0, 6, (16, 3))
    code, gap, n = pq_codes.assign(x, book, np.ones(16, bool), np.full(500, -1), np.zeros(500, np.int64))
    assert n == 500 * 16
    for _ in range(6):
        moved = r.random(16) < 0.3
        book = np.where(moved[:, None], r.integers(0, 6, (16, 3)), book)
        code, gap, n = pq_codes.assign(x, book, moved, code, gap)
        whole = pq_codes.squared(x, book)
        assert (code == whole.argmin(1)).all() and (gap == whole.min(1)).all() and n < 500 * 16
