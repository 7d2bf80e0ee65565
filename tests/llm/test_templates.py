"""Template classes against occurrence vectors that are really built, and odd rows of embeddings."""

import collections
import random

import numpy as np
import pytest

from mesaquery.llm import common, embedding_dedup, html_extract


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def tokens_of(page):
    """Each token's occurrences and first place."""
    pieces = html_extract.pieces_of(page)
    found, place = collections.Counter(), {}
    for k, p in enumerate(pieces):
        if p.name:
            found[p.key] += 1
            place.setdefault(p.key, k)
    for k, p in html_extract.texts_between(page, pieces) if found else ():
        found[p.key] += 1
        place.setdefault(p.key, k - 0.5)
    return found, place


def classes_of(pages, least_pages):
    """Of pages of one template: the outer class and all others as sets of tokens, by occurrence vectors."""
    read = [(f, p) for f, p in map(tokens_of, pages) if f]
    if len(read) < least_pages:
        return None
    vectors = {t: tuple(f[t] for f, _ in read) for f, _ in read for t in f}
    by = collections.defaultdict(list)
    for t, v in vectors.items():
        if sum(n > 0 for n in v) >= html_extract.SHARE * len(read):
            by[v].append(t)
    classes = {v: ts for v, ts in by.items() if len(ts) >= html_extract.LEAST_TOKENS}
    once = {v: sum(n == 1 for n in v) for v in classes}
    outer = [v for v in classes if once[v] >= html_extract.SHARE * len(read)]
    if not outer:
        return None
    best = max((once[v], len(classes[v])) for v in outer)
    return [frozenset(classes[v]) for v in outer if (once[v], len(classes[v])) == best], {frozenset(ts) for ts in classes.values()}


def site(rng, shape):
    """A page of a site: fixed frame, repeated items, optional parts, and texts that vary."""
    word = lambda: "".join(rng.choices("abcdef", k=6))
    items = "".join(f"<li class='{shape}'><b>{word()}</b></li>" for _ in range(rng.randrange(1, 5)))
    extra = f"<table class='x{shape}'><tr><td>{word()}</td></tr></table>" if rng.random() < 0.7 else ""
    return f"<html><head><title>{word()}</title></head><body class='{shape}'><nav>Home</nav><div id='main{shape}'><p>{word()}</p>{extra}</div><ul>{items}</ul><footer>© {shape}</footer></body></html>"


def test_classes_equal_built_vectors(spark):
    rng = random.Random(7)
    rows = [(host, site(rng, shape)) for host, shape, n in (("a", "s", 9), ("b", "t", 5), ("c", "s", 2), ("", "u", 4)) for _ in range(n)]
    rows += [("a", None), ("a", ""), ("b", "plain text"), ("lone", "<p>x</p>")]
    table = spark.createDataFrame([(h, i, t) for i, (h, t) in enumerate(rows)], "host string, page long, html string").repartition(3)
    got = {r.host: r.template for r in html_extract.templates_of(table).collect()}
    hosts = {h for h, _ in rows}
    want = {h: classes_of([t or "" for x, t in rows if x == h], html_extract.LEAST_PAGES) for h in hosts}
    want[None] = classes_of([t or "" for _, t in rows], 1)
    assert set(got) == {h for h, w in want.items() if w}
    for host, template in got.items():
        outer, every = want[host]
        assert frozenset(template[0]) in outer and {frozenset(x) for x in template} == every
        places = collections.defaultdict(list)
        for f, p in (tokens_of(t or "") for x, t in rows if host is None or x == host):
            for token, at in p.items():
                places[token].append(at / (len(f) + 1))
        if host is not None:
            mean = [sum(places[t]) / len(places[t]) for t in template[0]]
            assert mean == sorted(mean)


def test_an_empty_template_leaves_elements(spark):
    """No token is on enough pages, so that there's no template at all; classes that tie make one all the same."""
    pages = [(i, f"http://h{i}.org/", f"<x{i}><article>text {i}</article></x{i}>") for i in range(4)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(4)}
    tie = [(i, "http://t.org/", f"<html><body><i>1</i><u>2</u><s>{'3</s><s>' * (i % 2)}4</s><article>body {i}</article></body></html>") for i in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(tie, "page_id long, url string, html string")).collect()}
    assert got == {i: f"body {i}" for i in range(6)}


def test_embeddings_of_repeated_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16)).astype(np.float32)
    rows = [(i, v.tolist(), i % 3, "x", 1) for i, v in enumerate(base)] + [(i + 100, (base[i] + rng.normal(size=16) * 0.02).astype(np.float32).tolist(), None, None, None) for i in range(10)]
    rows += [rows[3], rows[3], (5, rows[7][1], 0, "y", 2), (None, rows[2][1], 1, "z", 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, block int").repartition(3)
    got = embedding_dedup.near_duplicates(table, threshold=0.9).collect()
    unit = np.array([r[1] for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9 - 1e-12
    near[-1], near[:, -1] = False, False  # rows without an id link with nothing
    assert len(got) == len(rows)
    links = collections.Counter()
    for i, r in enumerate(rows):
        links[r[0], max(0, int(near[i].sum()) - 1)] += 1
    assert collections.Counter((r.vec_id, r.n_links) for r in got) == links
    component = {i: r[0] for i, r in enumerate(rows)}
    for _ in rows:
        component = {i: min((component[j] for j in np.flatnonzero(near[i])), default=component[i]) for i in component}
    assert collections.Counter((r.vec_id, r.component_id) for r in got) == collections.Counter((rows[i][0], c) for i, c in component.items())
