"""The manifest against trees built level by level."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mesaquery.llm import common, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, _row string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves, fanout):
    """The root and each leaf's siblings as (left, right) of all levels."""
    row, at, proofs = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(row) > 1:
        runs = [row[i : i + fanout] for i in range(0, len(row), fanout)]
        for i, a in enumerate(at):
            run, k = runs[a // fanout], a % fanout
            proofs[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            at[i] = a // fanout
        row = [sha("".join(r)) for r in runs]
    return row[0], proofs


def rows_of(n, rng):
    out = [(i, rng.choice(["", "a\nb", "ä" * 9 + "\n", "x" * 5000, None]), rng.choice(["en", None, ""]), rng.choice(["hot"] * 6 + ["", None, "ä", "z", "B"]), rng.choice([None, i]), None, None) for i in rng.sample(range(5 * n), n)]
    out += [out[0]] * 5 + [(None, "t\n", None, "hot", None, None, None)] * 2
    return out + [(7 * n, "alone", "en", "alone", 5, None, None)]


def expected(rows, fanout):
    leaf = lambda r, text: sha("".join(map(field, (r[0], r[3], r[2], r[4], text))))
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])], fanout) for s in names}
    root, tops = tree([subs[s][0] for s in names], fanout)
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, _, own, r), below in zip(sorted(by[s], key=lambda x: x[:3]), subs[s][1], strict=True):
            path = below + top
            import zlib

            lost = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            at = seen = leaf(r, r[1].replace("\n", "")) if lost else own
            for left, right in path:
                at = sha(left + at + right)
            out.append((r[0], own, subs[s][0], root, sha("".join(a + b for a, b in path)), at, at == root, seen == own))
    return out


@pytest.mark.parametrize(("fanout", "levels", "n"), [(3, 1, 150), (3, 2, 400), (2, 3, 70), (3, 6, 1)])
def test_manifest_equals_brute_force(spark, monkeypatch, fanout, levels, n):
    rows = rows_of(n, random.Random(fanout * 100 + levels))
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda *a: whole(*a, fanout=fanout, levels=levels))
    got = merkle.audited(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = expected(rows, fanout)
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted((w[:7] for w in want), key=key)
    assert all(w[6] == w[7] for w in want)


def test_manifest_keeps_columns_and_proofs_fold(spark):
    rows = spark.createDataFrame([(i, "g" if i % 3 else None, sha(str(i)), "p") for i in range(40)], "id long, g string, leaf string, path string")
    got = merkle.manifest(rows, "g", ["id"], "leaf", levels=2)
    assert got.columns == ["id", "g", "leaf", "path", "path_", "subroot", "root"]
    assert got.where(merkle.folded(F.col("leaf"), F.col("path_")) == F.col("root")).count() == 40 and got.select("root").distinct().count() == 1


def test_manifest_of_no_rows(spark):
    assert merkle.audited(spark.createDataFrame([], SCHEMA)).count() == 0


def test_places_over_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), (F.col("id") % 5).alias("k"))
    got = merkle.numbered(rows, ["k", "x"]).collect()
    assert [(r.k, r.x) for r in sorted(got, key=lambda r: r.number)] == sorted((r.k, r.x) for r in got) and {r.number for r in got} == set(range(1000))
