"""Codes against Lloyd's rounds that scan everything."""

import hashlib
import math
import random

import numpy as np
import pytest

from mesaquery.llm import common, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, block string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def expected(rows, parts, entries, rounds):
    """{row: (code, error)} and the books' digest of rows (vec_id, vector, label)."""
    good = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(256 * x) for x in r[1]] for r in good]
    dims = len(ints[0])
    cuts = [dims * p // parts for p in range(parts + 1)]
    books = [[v[a:b] for v in ints[:entries]] for a, b in zip(cuts, cuts[1:])]
    cost = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    assign = lambda: [[min((cost(v[a:b], e), i) for i, e in enumerate(book)) for book, a, b in zip(books, cuts, cuts[1:])] for v in ints]
    for _ in range(rounds):
        now = assign()
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            for e in range(len(books[p])):
                own = [v[a:b] for v, m in zip(ints, now, strict=True) if m[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [("".join(f"{e:02x}" for _, e in m), sum(d for d, _ in m)) for m in assign()]
    return [(r[0], r[2], *f) for r, f in zip(good, found, strict=True)], hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims)) * 0.2
    made = (centres[rng.integers(0, 8, n)] + rng.normal(size=(n, dims)) * 0.05).astype(np.float32).tolist()
    rows = [(int(i), v, int(rng.integers(0, 3)) if i % 5 else None) for i, v in zip(rng.permutation(4 * n)[:n], made, strict=True)]
    odd = [(-5, None, 1), (-4, [None] + [0.5] * (dims - 1), 1), (-3, [float("nan")] + [0.5] * (dims - 1), None), (-2, [float("-inf")] * dims, 2), (-1, [0.0] * dims, 2)]
    return rows + odd + [rows[0]] * 3 + [(None, rows[1][1], None)]


@pytest.mark.parametrize(("parts", "dims", "entries", "rounds", "block"), [(4, 8, 16, 2, 1 << 20), (3, 7, 5, 6, 600), (4, 8, 300, 1, 900), (2, 4, 1, 2, 1 << 20)])
def test_codes_equal_lloyd(spark, monkeypatch, parts, dims, entries, rounds, block):
    monkeypatch.setattr(vector_codes, "BLOCK_BYTES", block)
    rows, scans = vectors(200, dims, parts + dims), []
    table = spark.createDataFrame([(*r, "c", "b") for r in rows], SCHEMA).repartition(3)
    if entries > 256:
        entries = 40
    got = vector_codes.compress(table, parts=parts, entries=entries, rounds=rounds, scans=scans).collect()
    want, digest = expected(rows, parts, entries, rounds)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key) and {r.codebooks_sha256 for r in got} == {digest}
    assert scans[0] == parts * len(want) and len(scans) == rounds + 1 and all(s <= scans[0] for s in scans)
    assert entries > 1 and sum(scans[1:]) < scans[0] * rounds or scans[1:] == [0] * rounds


def test_settled_codebooks_scan_little(spark):
    rng = np.random.default_rng(1)
    centres = np.eye(8) * 4
    data = [(i, (centres[i % 8] + rng.normal(size=8) * 0.01).astype(np.float32).tolist(), 0, "", "") for i in range(800)]
    scans = []
    vector_codes.compress(spark.createDataFrame(data, SCHEMA), parts=2, entries=8, rounds=3, scans=scans)
    assert scans[0] == 1600 and sum(scans[2:]) < 0.7 * 2 * scans[0]


def test_label_errors_of_null_labels(spark):
    rows = [(i, [i / 7, i / 3], None if i % 2 else i % 4, "", "") for i in range(20)]
    got = vector_codes.with_label_errors(vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=4)).collect()
    for r in got:
        assert r.label_error == sum(x.error for x in got if x.label == r.label) and len(got) == 20


def test_lengths_and_empty_tables(spark):
    table = spark.createDataFrame([(1, [0.5, 0.5], 1, "", ""), (2, [0.1] * 3, 1, "", ""), (3, [0.25, 0.5], 1, "", "")], SCHEMA)
    got = {r.vec_id: (r.code, r.error) for r in vector_codes.codes_query(table).collect()}
    assert got[2] == (None, None) and got[1][0] is not None and got[3][1] == 0
    assert vector_codes.codes_query(table.where("vec_id = 2 AND label = 2")).count() == 0
    assert [r.code for r in vector_codes.codes_query(spark.createDataFrame([(1, [], 1, "", "")], SCHEMA)).collect()] == ["00" * 16]


def test_heaps_pop_what_is_violated():
    rng = random.Random(4)
    keys = [sorted(rng.random() for _ in range(rng.choice([0, 3, 20]))) for _ in range(6)]
    ends = np.cumsum([len(k) for k in keys]).astype(np.int32)
    flat = np.array([x for k in keys for x in k])
    heaps = vector_codes.Heaps(flat, np.arange(len(flat), dtype=np.int32), ends)
    limits = np.array([0.3, 0.0, 0.9, 0.5, 2.0, 0.1])
    popped = dict(heaps.violated(limits))
    for h in range(6):
        a, b = heaps.starts[h], ends[h]
        assert sorted(popped.get(h, [])) == [i for i in range(a, b) if flat[i] <= limits[h]]
    left = heaps.put_back()
    assert sorted(left.rows.tolist()) == sorted(set(range(len(flat))) - {i for p in popped.values() for i in p})
