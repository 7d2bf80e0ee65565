import collections
import datetime as dt
import difflib
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from mesaquery.functions import numbers, text
from mesaquery.operators import derive, facets, menus, planning, pricing, recognition, resolve, scoring, snapshots, spatial, tagging
from mesaquery.sources import readers, sinks
from mesaquery.streaming import changes


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_half_even_and_ramp(spark):
    assert one(spark, numbers.half_even(F.lit(66.5))) == 66
    assert one(spark, numbers.ramp(F.lit(6.0), 12, 0)) == 50
    assert one(spark, numbers.ramp(F.lit(6.0), 3, 3)) == 100
    assert one(spark, numbers.ramp(F.lit(None).cast("double"), 0, 1)) is None


def test_shrinkage(spark):
    assert abs(one(spark, numbers.shrink(F.lit(4.9), F.lit(14), F.lit(4.5))) - 4.534) < 1e-3


def test_names_and_addresses(spark):
    assert one(spark, text.match_name(F.lit("The Café"))) == "cafe"
    assert one(spark, text.match_name(F.lit("The NYC"))) == "the nyc"
    assert one(spark, text.street_numbers(F.lit("10-07 50th Ave"))) == ["1007"]
    assert one(spark, text.street_numbers(F.lit("32 W. 32nd St."))) is None
    assert one(spark, text.subset_jaccard(F.array(F.lit("53")), F.array(F.lit("53"), F.lit("nyc")))) == 1.0
    assert one(spark, text.fold(F.lit("Él–’x"))) == "el-'x"


def test_comparables_need_starters_and_mains(spark):
    rows = spark.createDataFrame([("a", 24.0), ("a", 30.0), ("b", 60.0)], "k string, p double")
    got = {r.k: r.comparable for r in pricing.comparables(rows, "k", "p").collect()}
    assert got == {"a": 65, "b": None}


def test_largest_gap_ties_to_the_cheapest(spark):
    rows = spark.createDataFrame([("a", 40, {"$45": 5, "$30": 5})], "k string, comparable long, gaps map<string,long>")
    assert pricing.largest_gap(rows, "k").first().tier == "$30"


def test_strict_percentile(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (3.0,), (5.0,), (None,)], "v double")
    assert sorted((r.pct for r in scoring.strict_percentile(rows, "v").collect() if r.pct is not None)) == [0, 25, 25, 75]


def test_rubric_without_weight_is_unknown(spark):
    row = scoring.rubric(spark.createDataFrame([(1.0,)], "a double"), {"a": 0}).first()
    assert row.score is None and row.completeness == 0


def test_era(spark):
    assert [one(spark, scoring.era(F.lit(y), 2026)) for y in (2025, 2024, 2021, 2020, 2011, 2010)] == ["current", "recent", "recent", "past", "past", "historic"]


def test_facet_counts_equal_brute_force(spark):
    rows = spark.createDataFrame([(1, ["x", "y"], ["p"]), (2, ["y"], ["q"]), (3, [], ["p"]), (4, None, ["q"])], "id int, a array<string>, b array<string>")
    fs = [facets.Facet("a", F.col("a")), facets.Facet("b", F.col("b"))]
    got = {(r.facet, r.value): r.n for r in facets.facet_counts(rows, fs, facets.QuerySpec({"a": ("y",)})).collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, ("b", "p"): 1, ("b", "q"): 1}


def test_query_state_round_trip():
    spec = facets.QuerySpec({"a": ("x~y", "é & ="), "b": ("1",)}, "soup", 4.2, "name_asc", 2, "2026-08-05", "2026-08-20", True, "map")
    assert facets.QuerySpec.from_params(spec.to_params(), facets.named_sorts(), ("a", "b")) == spec
    assert spec.active() == 8 and spec.reset().active() == 0
    read = lambda p: facets.QuerySpec.from_params(p, ("name_asc",), ("a",), today="2026-08-01")
    assert read("").open_on == "2026-08-01" and read("by=any").open_on is None and "by=any" in facets.QuerySpec().to_params()
    assert read("by=any&sort=constructor&zz=1&minr=abc&page=-3") == facets.QuerySpec()


def test_active_filters_and_presets():
    spec = facets.QuerySpec({"a": ("x", "y")}, floor=4.0, open_on="2026-08-05")
    listed = spec.listed([facets.Facet("a", F.lit(1), title="A", labels={"x": "Ex"})], unrated=3)
    assert [(t, v) for t, v, _ in listed] == [("A", "Ex"), ("A", "y"), ("Rating", "4.0+ · 3 unrated hidden"), ("Open on", "2026-08-05")]
    assert listed[0][2].selected == {"a": ("y",)} and listed[2][2].floor is None and all(x.active() == spec.active() - 1 for _, _, x in listed)
    preset = facets.Preset("p", facets.QuerySpec({"a": ("x",)}, sort="rank_asc"), F.lit(True))
    assert preset.is_on(spec) and preset.toggled(spec) == facets.QuerySpec() and preset.toggled(facets.QuerySpec({"b": ("1",)})) == preset.spec


def test_date_issue(spark):
    day = lambda x: F.lit(dt.date.fromisoformat(x))
    issue = lambda d, sat, sun: one(spark, planning.date_issue(day(d), day("2026-08-03"), day("2026-08-31"), F.lit(sat), F.lit(sun)))
    assert issue("2026-08-01", True, True) == "past" and issue("2026-09-01", True, True) == "closed"
    assert issue("2026-08-08", False, True) == "no saturday" and issue("2026-08-09", True, None) == "no sunday"
    assert issue("2026-08-04", False, False) is None
    assert one(spark, numbers.date_range(day("2026-08-05"), day("2026-08-03"))) == []


def test_resolution_tiers(spark):
    v = spark.createDataFrame([("s1", "alpha", ["1"], 1), ("s2", "beta grill", None, 2), ("s3", "gamma", ["3"], 3), ("s4", "gamma", ["4"], 4)], "slug string, name string, streets array<string>, pos int")
    e = spark.createDataFrame([("a", "alpha", ["1"]), ("b", "alpha", ["9"]), ("c", "beta grill", ["2"]), ("d", "gamma", ["4"]), ("e", "beta grills", None), ("f", "zzz", None)], "ext string, name string, streets array<string>")
    got = {r.ext: (r.slug, r.status) for r in resolve.resolve(e, v).collect()}
    assert got == {"a": ("s1", "matched"), "b": ("s1", "review"), "c": ("s2", "matched"), "d": ("s4", "matched"), "e": ("s2", "review")}


def test_later_high_tag_replaces(spark):
    rules = [tagging.TagRule("t", "a", "low"), tagging.TagRule("t", "b"), tagging.TagRule("t", "c"), tagging.TagRule("t", "d", "low")]
    rows = spark.createDataFrame([(1, "a b c d"), (2, "a d"), (3, None)], "id int, text string")
    got = {r.id: r.confidence for r in tagging.tag_items(rows, "text", rules).collect()}
    assert got == {1: "high", 2: "low"}


def test_diff_and_sinks(spark, tmp_path):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert sorted((r.k, r.change) for r in snapshots.diff(old, new, "k", ["v"]).collect()) == [(1, "dropped"), (2, "changed"), (3, "added")]
    path = str(tmp_path / "p")
    assert sinks.write_if_changed(old, path) and not sinks.write_if_changed(old, path) and sinks.write_if_changed(new, path)
    sinks.snapshot(old, str(tmp_path / "s"), "2026-01-01")
    sinks.snapshot(new, str(tmp_path / "s"), "2026-02-01")
    assert sinks.latest_snapshot(spark, str(tmp_path / "s")).count() == 2
    assert readers.banned_fields(spark.createDataFrame([], "a struct<x:int>, b array<struct<y:int>>").schema, frozenset("y")) == ["b.y"]


def test_keyed_object_keeps_string_keys(spark, tmp_path):
    (tmp_path / "k.json").write_text('{"53": {"n": 1}, "x": {}}')
    got = readers.keyed_object(spark, str(tmp_path / "k.json"), "struct<n:int>").collect()
    assert sorted((r.slug, r.n) for r in got) == [("53", 1), ("x", None)]


def test_stream_keeps_latest(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "t")
    src.mkdir()
    (src / "1.json").write_text('{"k": 1, "at": 1}\n{"k": 1, "at": 2}\n{"k": 2, "at": 1}')
    run = lambda: changes.keep_latest(changes.new_files(spark, str(src), "k int, at int"), "k", ["at"], table, str(tmp_path / "c"), 4).awaitTermination()
    rows = lambda: sorted(tuple(r) for r in changes.latest_rows(spark, table, "k int, at int", 4).collect())
    assert rows() == []
    run()
    assert rows() == [(1, 2), (2, 1)]
    (src / "2.json").write_text('{"k": 2, "at": 5}\n{"k": 3, "at": 0}')
    run()
    assert rows() == [(1, 2), (2, 5), (3, 0)]
    assert all(len(list(p.glob("batch=*"))) == 1 for p in (tmp_path / "t").iterdir())


def test_tables_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.range(3).toDF("n"), path)
    sinks.replace(spark.read.parquet(path).where("n > 0"), path)  # reads what it replaces
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 2] and [p.name for p in tmp_path.iterdir()] == ["t"]
    asked = []
    look = lambda df: asked.append(sorted(r.k for r in df.collect())) or df.selectExpr("k", "k * 2 AS v")
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    cache = str(tmp_path / "c")
    assert sorted(tuple(r) for r in sinks.read_through(wanted, "k", cache, look).collect()) == [(1, 2), (2, 4)]
    assert sorted(tuple(r) for r in sinks.read_through(wanted.union(spark.createDataFrame([(5,)], "k long")), "k", cache, look).collect()) == [(1, 2), (2, 4), (5, 10)]
    assert asked == [[1, 2], [5]]


def test_landed_files(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "_stamp").write_text("2026-08-03\n")
    for n, slugs in ((10, "ca"), (2, "ab")):
        (pages / f"p{n}.json").write_text('{"items": [' + ",".join(f'{{"slug": "{x}", "summary": "{n}"}}' for x in slugs) + "]}")
    found = readers.listing_items(readers.listing_pages(spark, str(pages), "2026-08-03"))
    assert sorted((r.slug, r.summary) for r in found.collect()) == [("a", "2"), ("b", "2"), ("c", "10")]
    assert readers.listing_pages(spark, str(pages), "2026-08-04").count() == 0
    (tmp_path / "s").mkdir()
    for day, total in (("2026-08-01", 1), ("2026-08-10", 2)):
        (tmp_path / "s" / f"{day}.json").write_text(f'{{"total": {total}}}')
    assert readers.latest_file(spark, str(tmp_path / "s"), readers.LISTING).first().total == 2
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.pdf").write_bytes(b"one|two|three")
    (tmp_path / "b" / "y.pdf").write_bytes(b"!")

    def parse(content):
        if content == b"!":
            raise ValueError
        return content.decode().split("|")

    files = readers.binary_texts(spark, str(tmp_path / "b"), parse, pages=2)
    assert sorted(r.text for r in files.collect()) == ["", "one\ntwo"]
    links = spark.createDataFrame([("x", "u"), ("z", "v")], "slug string, url string")
    got = {r.slug: (r.file, r.error, r.sha256 is None) for r in readers.manifest(files, links, "slug").collect()}
    assert got == {"x": ("x.pdf", None, False), "z": (None, "missing", True)}
    (tmp_path / "out.json").write_text('{"slug": "53", "subway": {"4": 3}, "end_date": "2026-08-31"}')
    row = readers.json_files(spark, str(tmp_path / "out.json"), readers.PAYLOAD).first()
    assert (row.slug, row.subway, row.end_date) == ("53", {"4": 3}, dt.date(2026, 8, 31))


def test_similar_names_equal_brute_force(spark):
    """Blocking on rare grams finds every pair that comparing all names with all finds."""

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcde ") for _ in range(n)).strip() or "x"
    names = [word(rng.choice([2, 4, 6, 9, 12, 20, 40])) for _ in range(120)]
    near = []
    for n in names:
        t = list(n)
        for _ in range(rng.choice([1, 1, 2, 4])):
            t[rng.randrange(len(t))] = rng.choice(["", "z", "aa"])
        near.append("".join(t).strip() or "y")
    near = [n for n in near if n not in names]  # equal names are found by name
    v = spark.createDataFrame([(f"s{i}", n, ["1"] if i % 3 else None, i) for i, n in enumerate(names)], "slug string, name string, streets array<string>, pos int")
    e = spark.createDataFrame([(i, n, ["1"]) for i, n in enumerate(near)], "ext int, name string, streets array<string>")
    got = {r.ext: (r.slug, round(r.confidence, 9), r.status) for r in resolve.by_ratio(e, v).collect()}
    first = {n: i for i, n in reversed(list(enumerate(names)))}
    want = {}
    for i, n in enumerate(near):
        ratio, at, name = max((difflib.SequenceMatcher(None, n, m).ratio(), -at, m) for m, at in first.items())
        if ratio >= 0.85:
            sure = ratio >= 0.92 and names.count(name) == 1 and -at % 3 > 0
            want[i] = (f"s{-at}", 0.8 if sure else round(ratio, 9), "matched" if sure else "review")
    assert len(want) > 25 and got == want


def test_names_that_must_and_must_not_meet(spark):
    same = [("Blue Fin Restaurant", "Blue Fin"), ("The Russian Tea Room", "Russian Tea Room"), ("Restaurant Le B", "Le B."), ("Sylvia's Restaurant", "Sylvia's"), ("Elcielo New York", "Elcielo"), ("Josephs", "Joseph’s"), ("Cafe Boulud", "Café Boulud"), ("X New York City", "X")]
    apart = [("Bar Boulud", "Café Boulud"), ("Brasserie", "Osteria Brooklyn"), ("Osteria Morini", "Morini"), ("Bar Primi", "Primi")]
    rows = spark.createDataFrame(same + apart + [("Brooklyn", "The Restaurant")], "a string, b string")
    got = rows.select(text.match_name(F.col("a")).alias("a"), text.match_name(F.col("b")).alias("b")).collect()
    assert all(r.a == r.b for r in got[: len(same)]) and all(r.a != r.b for r in got[len(same) :]) and all(r.a and r.b for r in got)


def test_text_forms(spark):
    assert one(spark, text.clean(F.lit("Caf\ufffde\u0301\t a\n  b\x00"))) == "Caf'é a b"
    assert one(spark, text.fold(F.lit("Éʼ′‒−“x”"))) == "e''--\"x\""
    assert one(spark, text.title_case(F.lit("don't add-ons ÉCLAIR 2nd"))) == "Don'T Add-Ons Éclair 2Nd"
    assert [tuple(one(spark, text.dish_parts(F.lit(x)))) for x in ("A — b - c", "A:  b: c", "A-b", "A  –  b")] == [("A", "b - c"), ("A", "b: c"), ("A-b", None), ("A", "b")]


def test_quotations_stay_within_the_budget(spark):
    rules = [tagging.TagRule("a", "oyster"), tagging.TagRule("b", "steak", "low"), tagging.TagRule("c", "toro"), tagging.TagRule("d", "nothing")]
    menu = "x" * 300 + " fresh oyster platter with lemon and herbs " + "y" * 700 + " grilled steak of the house " + "z" * 10 + " toro of tuna " + "w" * 200
    hits = [("s", "a", "high", "item", "fresh oyster platter with lemon and herbs"), ("s", "a", "low", "item", "oyster"), ("s", "b", "low", "raw_text", "grilled steak of the house"), ("s", "c", "high", "item", "toro of tuna"), ("s", "d", "high", "item", "no such word here at all"), ("t", "b", "high", "item", "steak"), ("t", "zz", "high", "item", "steak")]
    h = spark.createDataFrame(hits, "slug string, tag string, confidence string, source string, matched string")
    sources = spark.createDataFrame([("s", menu)], "slug string, raw string")
    got = {(r.slug, r.tag): r for r in tagging.quoted(h, sources, "slug", rules).collect()}
    assert set(got) == {("s", "a"), ("s", "b"), ("s", "c"), ("s", "d"), ("t", "b")}
    assert got["s", "a"].confidence == "high" and got["s", "a"].keyword == "oyster" and "oyster" in got["s", "a"].quotation
    # 4.5 % of 1,301 characters are 58: what is left after the first makes the second narrower.
    assert len(got["s", "a"].quotation.strip("…")) + len(got["s", "b"].quotation.strip("…")) <= int(len(menu) * 0.045)
    assert got["s", "b"].quotation == "grilled steak of the…" and got["s", "c"].quotation is None  # too near the second
    assert got["s", "d"].keyword is None and got["t", "b"].quotation == "steak"


def test_short_names_of_a_ratio_are_all_found(spark):
    rng = random.Random(31)
    names = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 13))) for _ in range(260)})
    v = spark.createDataFrame([(f"s{i}", n, None, i) for i, n in enumerate(names[::2])], "slug string, name string, streets array<string>, pos int")
    e = spark.createDataFrame([(i, n, None) for i, n in enumerate(names[1::2])], "ext int, name string, streets array<string>")
    got = {r.ext: round(r.confidence, 9) for r in resolve.by_ratio(e, v).collect()}
    best = {i: max(difflib.SequenceMatcher(None, n, m).ratio() for m in names[::2]) for i, n in enumerate(names[1::2])}
    assert got == {i: round(r, 9) for i, r in best.items() if r >= 0.85} and len(got) > 20


def kept_quotations(hits, source, patterns, budget):
    """(tag, keyword, quotation) of (tag, matched) in order, decided one by one."""
    source = " ".join(source.split())
    room, taken, out = max(budget.floor, int(len(source) * budget.share)), [], []
    runs = lambda x: {p[i : i + budget.run] for p in [re.sub(r"\W+", " ", x.lower())] for i in range(len(p) - budget.run + 1)}
    for tag, matched in hits:
        at = text.most_central(matched, patterns[tag])
        quotes = budget.quotes(matched, at)
        core = lambda q: q.strip("…").strip()
        made = next((q for q in quotes if len(core(q)) <= room), quotes[-1]) if source else quotes[0]
        start = source.find(core(made)) if source else -1
        stop = start + len(core(made))
        fits = all(runs(quotes[0]).isdisjoint(runs(q)) for _, _, q in out if q)
        if source:
            fits = fits and len(core(made)) <= room and (start < 0 or all(start >= b + budget.gap or stop <= a - budget.gap for a, b in taken))
            if fits:
                taken.append((start, stop))
                room -= len(core(made))
        out.append((tag, text.cleaned(matched[slice(*at)]) if at else None, made if fits else None))
    return out


def test_quotations_equal_deciding_one_by_one(spark):
    """Two tags of one passage, sources that are short, long, missing and empty, and hits that aren't in the source."""
    rng = random.Random(21)
    words = ["oyster", "Steak", "toro", "herbs", "lemon", "platter", "grilled", "Café", "x" * 30, "and", "of", "the", "…"]
    rules = [tagging.TagRule(t, t) for t in ("oyster", "steak", "toro", "herbs", "and", "lemon")] + [tagging.TagRule("toro", "grill(ed)?")]
    patterns = {}
    for r in rules:
        patterns.setdefault(r.tag, []).append(re.compile(r.pattern, re.IGNORECASE))
    hits, sources = [], []
    for k in range(120):
        raw = rng.choice(["  ", "\n", " "]).join(rng.choices(words, k=rng.choice([5, 40, 400, 2000])))
        flat = " ".join(raw.split())
        for tag in rng.sample(sorted(patterns), rng.randrange(1, 6)):
            a = rng.randrange(max(1, len(flat) - 40))
            hits.append((f"k{k}", tag, rng.choice(["high", "low"]), rng.choice(["item", "raw_text"]), rng.choice([flat[a : a + 143], flat[:143], "an oyster that isn't there, with lemon and toro", tag])))
        if k % 10:
            sources.append((f"k{k}", rng.choice([raw, raw, raw, "", None])))
    budget = tagging.QuoteBudget(share=0.2)
    got = {}
    table = spark.createDataFrame(hits, "slug string, tag string, confidence string, source string, matched string")
    for r in tagging.quoted(table, spark.createDataFrame(sources, "slug string, raw string"), "slug", rules, budget=budget).collect():
        got.setdefault(r.slug, []).append((r.tag, r.keyword, r.quotation))
    raws = {k: v or "" for k, v in sources}
    want = {}
    for k in {h[0] for h in hits}:
        own = sorted((t, m) for s, t, _, _, m in hits if s == k)
        want[k] = kept_quotations(own, raws.get(k, ""), patterns, budget)
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()} == want
    flat = [q for v in want.values() for *_, q in v]
    assert 50 < sum(q is not None for q in flat) < len(flat) - 50


def test_quotations_are_compared_before_they_shrink(spark):
    """Two tags of one passage: the second is rejected for what its widest quotation shares, not its narrow one."""
    passage = "fresh oyster platter with lemon and herbs"
    rules = [tagging.TagRule("a", "oyster"), tagging.TagRule("b", "herbs"), tagging.TagRule("c", "steak")]
    menu = "x" * 1100 + f" {passage} " + "y" * 800
    hits = spark.createDataFrame([("s", t, "high", "item", m) for t, m in (("a", passage), ("b", passage), ("c", "steak"))], "slug string, tag string, confidence string, source string, matched string")
    got = {r.tag: (r.keyword, r.quotation) for r in tagging.quoted(hits, spark.createDataFrame([("s", menu)], "slug string, raw string"), "slug", rules, budget=tagging.QuoteBudget(gap=0)).collect()}
    assert got == {"a": ("oyster", "fresh oyster platter with lemon and…"), "b": ("herbs", None), "c": ("steak", "steak")}  # the last is nowhere in the source


@pytest.mark.parametrize("cell_rows", [1, 7, 4096])
def test_distance_join_equals_all_pairs(spark, cell_rows):
    """A dense town, copies, borders, poles within reach, the date line, and rows without coordinates."""
    rng = random.Random(cell_rows)
    town = [(40.7 + rng.gauss(0, 0.004), -74 + rng.gauss(0, 0.004)) for _ in range(150)]
    far = [(rng.uniform(-74, 74), rng.uniform(-180, 180)) for _ in range(60)]
    line = [(10 + rng.random() * 0.01, rng.choice([-180, 179.995, -179.995, 180.0]) + rng.random() * 0.004) for _ in range(40)]
    line = [(a, min(b, 180.0)) for a, b in line]
    points = town + [town[0]] * 30 + far + [(a + 0.003, b) for a, b in far] + line + [(None, 1.0), (1.0, None), (0.0, 0.0), (-1e-9, 0.0)]
    rng.shuffle(points)
    a, b = list(enumerate(points[::2])), list(enumerate(points[1::2]))
    make = lambda rows: spark.createDataFrame([(i, x, y) for i, (x, y) in rows], "id int, lat double, lng double").repartition(3)

    def metres(p, q):
        h = math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6_371_000.0 * math.asin(math.sqrt(min(1, h)))

    for reach in (80, 1000):
        got = [(r.id, r.r_id) for r in spatial.within(make(a), make(b), reach, cell_rows=cell_rows).collect()]
        want = {(i, j) for i, p in a for j, q in b if None not in (*p, *q) and metres(p, q) <= reach}
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    assert spatial.within(make(a), make([]), 80).count() == 0


def test_cells_hold_few_rows(spark):
    rng = random.Random(3)
    cell = lambda: (rng.choice([5, 5, 5, rng.randrange(4000)]), rng.choice([7, 7, rng.randrange(4000)]))
    left, right = ([cell() for _ in range(900)] for _ in range(2))
    make = lambda rows: spark.createDataFrame(rows, "y long, x long")
    held = collections.Counter()
    leaf = {(r.y, r.x): (r.level, r.l_deals, r.r_deals) for r in spatial.cells(make(left), make(right), 50).collect()}
    assert set(leaf) == set(left)
    for y, x in left:
        level, l_deals, _ = leaf[y, x]
        up = spatial.HALVINGS - level
        held[level, y >> up, x >> up, l_deals] += 1
    assert all(n <= 50 * deals for (*_, deals), n in held.items()) and any(deals > 1 for *_, deals in held) and len({k[0] for k in held}) > 2


def test_medians_by_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 8 + ["a", None, "b"]), rng.choice([None, rng.randrange(60), rng.random() * 60, 22.0])) for _ in range(3000)] + [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    table = spark.createDataFrame([(k, None if p is None else float(p)) for k, p in rows], "k string, p double")
    by = {}
    for k, p in rows:
        if p is not None:
            by.setdefault(k, []).append(float(p))
    for parts in (2, 16, 256):
        got = {r.k: r.middle for r in scoring.middles(table, ["k"], "p", parts).collect()}
        assert got == {k: statistics.median(v) for k, v in by.items()}
    bands = pricing.Bands((1, 30), (20, 45), (1, 15), 14.0)
    same = lambda df: sorted(map(str, df.collect()))
    assert same(pricing.spread_comparables(table, "k", "p", bands)) == same(pricing.comparables(table, "k", "p", bands))
    assert scoring.middles(table.limit(0), ["k"], "p").count() == 0


def test_medians_of_totals_and_many_keys(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 5 + ["a", None]), rng.choice([float(rng.randrange(9)), rng.random() * 60, 22.0, None])) for _ in range(1500)] + [("none", None)]
    table = spark.createDataFrame(rows, "k string, p double")
    under = {"low": lambda p: p < 30, "any": lambda p: True, "high": lambda p: p >= 22, "never": lambda p: p > 99}
    by = collections.defaultdict(list)
    for k, p in rows:
        for name, holds in under.items():
            if p is not None and holds(p):
                by[False, k, name].append(p)
                by[True, None, name].append(p)
    within = {"low": F.col("p") < 30, "any": F.lit(True), "high": F.col("p") >= 22, "never": F.col("p") > 99}
    for most in (scoring.BROADCAST_KEYS, 0):
        monkeypatch.setattr(scoring, "BROADCAST_KEYS", most)
        got = [((r.total, r.k, r.within), r.middle) for r in scoring.middles(table, ["k"], "p", 32, within, total=True).collect()]
        assert len(got) == len(by) and dict(got) == {k: statistics.median(v) for k, v in by.items()}
    bands = pricing.Bands((1, 30), (20, 45), (1, 15), 14.0)
    both = table.withColumn("total", F.lit(False)).union(table.select(F.lit(None).cast("string"), "p", F.lit(True)))
    want = pricing.comparables(both.withColumn("k", F.struct("k", "total")), "k", "p", bands).select("k.*", "n_prices", "exact", "comparable")
    assert sorted(map(str, pricing.spread_comparables(table, "k", "p", bands, total=True).collect())) == sorted(map(str, want.collect()))


def test_medians_leave_rows_where_they_are(spark):
    sc = spark.sparkContext._jsc.sc()

    def moved():
        sc.listenerBus().waitUntilEmpty(30_000)
        none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        stages = sc.statusStore().stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    rows, before = spark.range(0, 60_000, 1, 4).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 60_000 / 1000).alias("p")), moved()
    assert scoring.middles(rows, ["k"], "p").count() == 3
    assert moved() - before < 20_000
    before = moved()
    assert pricing.spread_comparables(rows, "k", "p", pricing.Bands((1, 30), (20, 45), (1, 15), 14.0)).count() == 3
    assert moved() - before < 20_000


def test_menu_lines(spark):
    menu = "Dinner\r\nSteak - rare\n\nEntrée :\nFish of the day\n$12\nFollow us on all sites\nPie supplement\n" + "long " * 30
    docs = spark.createDataFrame([(1, menu), (2, None), (3, "Desserts")], "k int, text string")
    got = [tuple(r)[2:] for r in menus.dishes(menus.menu_lines(docs, "k", "text"), "k").orderBy("pos").collect()]
    assert got == [("Dinner", "Steak", "rare", None), ("Entrée ", "Fish of the day", None, None), ("Entrée ", "Pie supplement", None, None)]
    assert {r.k: r.grade for r in menus.graded(docs, "k", "text").collect()} == {1: "partial", 2: "failed", 3: "failed"}


def test_positions(spark):
    rows = spark.range(1000).selectExpr("id * id AS k").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    got = {r.k: r.position for r in scoring.positions(rows, "k", parts=7).collect()}
    assert got == {i * i: i for i in range(1000)} | {None: None}


def test_labels(spark):
    got = one(spark, derive.offer_terms(F.array(F.lit("$60 Sunday Dinner Price"), F.lit("$30 Lunch"), F.lit(None))))
    assert (got.tiers, got.periods, got.sunday) == (["$30", "$60"], ["dinner", "lunch"], True)
    ends = {"Week 7 (Sept 1 - Sept 6)": dt.date(2026, 9, 6), "Week 6 (Aug 24 - 31)": dt.date(2026, 8, 31), "Week 6": None, "W (Feb 3 - 30)": None}
    assert {k: one(spark, derive.end_of_labels(F.array(F.lit(k)), 2026)) for k in ends} == ends
    assert one(spark, derive.end_of_labels(F.array().cast("array<string>"), 2026)) is None
    assert one(spark, derive.without_own(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.lit("b"))) == ["a", "a"]


def test_page_texts(spark):
    page = '<script type="application/ld+json">{"@graph": [{"openingHours": "Mo 9-5"}, {"x": 1}]}</script><script type="application/ld+json">[{"openingHoursSpecification": "all"}]</script><script type="application/ld+json">{bad</script><p>Mon - Fri: 9am - 5:30pm</p><b>Mon - Fri: 9am - 5:30pm</b> Sat 10 am to 4 pm'
    assert one(spark, text.opening_hours(F.lit(page))) == ["Mo 9-5", "all"]
    assert one(spark, text.hours_in_text(F.lit(page))) == ["Mon - Fri: 9am - 5:30pm", "Sat 10 am to 4 pm"]
    assert one(spark, text.listed_rank(F.lit("Ranked No. 12 of all"))) == 12
    assert one(spark, text.listed_rank(F.lit("none"))) is None


def test_ranked_links(spark):
    hrefs = ["http://a.com/dining", "http://a.com/food/menu#", "http://b.com/menu", "http://b.com/menu.pdf", "http://a.com/menu-jobs", "mailto:x", "http://a.com/dining"]
    got = one(spark, text.ranked_links(F.array(*map(F.lit, hrefs)), F.lit("http://a.com/"), "menu|din", "jobs", "menu"))
    assert (got.pages, got.files) == (["http://a.com/food/menu", "http://a.com/dining"], ["http://b.com/menu.pdf"])


def test_quotation_texts(spark):
    assert one(spark, text.shares_run(F.lit("a shared run of many letters"), F.lit("the SHARED -- run of many")))
    assert not one(spark, text.shares_run(F.lit("short"), F.lit("short")))
    assert one(spark, text.central_match(F.lit("egg and eggs and egg"), "eggs?")) == "eggs"
    assert one(spark, text.central_match(F.lit(None).cast("string"), "x")) is None
    assert one(spark, text.recentred(F.lit("one two three four"), F.lit(4), F.lit(7), 5)) == "one two…"


def test_outdoor_licences(spark):
    words = lambda *w: list(w)
    v = spark.createDataFrame([("a", words("blue", "fin"), "12", 40.7, -74.0), ("b", words("zed"), None, 40.7, -74.0), ("c", words("far"), "9", 40.7, -74.01), ("d", words("x"), "1", None, None)], "slug string, name_words array<string>, house string, lat double, lng double")
    li = spark.createDataFrame([("Blue Fin", words("blue", "fin"), words("corp"), "12", True, False, 40.7001, -74.0), ("Blue", words("blue"), words("q"), "3", False, True, 40.7002, -74.0), ("Far", words("far"), words("y"), "9", True, True, 40.7015, -74.01)], "name string, words array<string>, legal_words array<string>, house string, sidewalk boolean, roadway boolean, lat double, lng double")
    got = {r.slug: (r.licence, r.sidewalk, r.roadway) for r in spatial.licensed(v, li, "slug").collect()}
    assert got == {"a": ("Blue Fin", True, True), "c": ("Far", True, True)}


def test_walk_key(spark):
    routes = F.create_map(F.lit("4"), F.lit(7), F.lit("5"), F.lit(3))
    assert one(spark, facets.walk_key(routes, F.lit(2), ("4", "6"))) == 7
    assert one(spark, facets.walk_key(routes, F.lit(2))) == 2


def _by_pairs(externals, venues):
    """What ``by_name`` gives, from all pairs of rows of a name."""
    out = {}
    for ext in {e[0] for e in externals}:
        pairs = [(e, v) for e in externals for v in venues if e[0] == ext and e[1] is not None and e[1] == v[1]]
        if not pairs:
            continue
        met = [v for e, v in pairs if {*(e[2] or [])} & {*(v[2] or [])} - {None}]
        alone = len(pairs) == 1 and (pairs[0][0][2] is None or pairs[0][1][2] is None)
        pick = min(met or [v for _, v in pairs], key=lambda v: v[3])
        out[ext] = (pick[0], 1.0 if met else 0.9 if alone else 0.5, "matched" if met or alone else "review")
    return out


def test_names_shared_by_many(spark):
    rng = random.Random(5)
    streets = lambda: rng.choice([None, [], [None, "1"], [*map(str, rng.choices(range(9), k=2))]])
    name = lambda: rng.choice(["a", "b", "c d", None, f"n{rng.randrange(40)}"])
    externals = [(i % 150 if i % 150 else None, name(), streets()) for i in range(160)]
    venues = [(i, name(), streets(), 200 - i) for i in range(120)]
    e = spark.createDataFrame(externals, "ext long, name string, streets array<string>")
    v = spark.createDataFrame(venues, "slug long, name string, streets array<string>, pos long")
    assert {r.ext: (r.slug, r.confidence, r.status) for r in resolve.by_name(e, v).collect()} == _by_pairs(externals, venues)


def _join_rows(plan):
    """The most rows that a join of a plan that has run gave."""
    name = plan.nodeName()
    inner = plan.executedPlan() if "AdaptiveSparkPlan" in name else plan.plan() if "QueryStage" in name else None
    below = [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    return max([own, *map(_join_rows, below)])


def test_names_never_meet_in_pairs(spark):
    e = spark.range(2_000).selectExpr("id AS ext", "'a' AS name", "array(string(id % 50)) AS streets")
    v = spark.range(2_000).selectExpr("id AS slug", "'a' AS name", "array(string(id % 50)) AS streets", "id AS pos")
    found = resolve.by_name(e, v)
    assert {(r.ext % 50, r.status) for r in found.collect()} == {(i, "matched") for i in range(50)}
    assert 2_000 <= _join_rows(found._jdf.queryExecution().executedPlan()) <= 4_000


def test_a_file_each_in_few_folders(spark, tmp_path):
    rows = spark.range(1_200).selectExpr("id % 1199 AS k", "CASE WHEN id = 7 THEN NULL ELSE to_json(named_struct('slug', string(id), 'lat', double(id), 'x', 'ä\\n')) END AS v")
    path = f"file://{tmp_path}/each"
    sinks.file_each(rows, F.concat(F.lit("k="), "k"), F.col("v"), path, 500)
    (tmp_path / "each" / "0000000" / "_left").write_text('{"slug": "of an attempt that failed"}')
    (tmp_path / "each" / "0000001" / "list.txt").write_text('[{"slug": "a"},\n {"slug": "b"}]')
    (tmp_path / "each" / "0000001" / "broken.txt").write_text("{")
    assert len(list((tmp_path / "each").iterdir())) == 3  # folders, however many files
    files = readers.small_files(spark, path)
    assert files.count() == 1_202 and files.rdd.getNumPartitions() <= 3
    got = [(r.slug, r.lat) for r in readers.json_documents(files, readers.DETAIL).collect()]
    want = [(str(i), float(i)) for i in range(1_200) if i != 7] + [("a", None), ("b", None), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = readers.texts_of(files, lambda content: content.decode()[:-1]).where(F.col("path").contains("k=8-"))
    assert [r.text for r in texts.collect()] == [r.v for r in rows.where("k = 8").collect()]


def test_best_candidates_by_many_tasks(spark):
    rows = spark.range(5_000).selectExpr("id div 5 AS k", "id % 5 AS pos", "id % 3 = 0 AS accepted", "double(id % 7) AS similarity")
    plain, spread = (resolve.best_candidate(rows, "k", "pos", parts=n) for n in (None, 7))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))
    assert spread.rdd.getNumPartitions() == 7


def test_long_lists_meet_few_tasks(spark):
    rows = spark.range(40_000).selectExpr("id AS k", "nullif(id % 3, 0) AS n", "' A ' AS s")
    table = spark.range(30).selectExpr("nullif(id % 3, 0) AS n", "if(id < 27, 'a', 'b') AS s", "concat('v', id) AS v")
    got = recognition.looked_up(rows, table, ["n"], "s", "v")
    want = {n: sorted(f"v{i}" for i in range(27) if i % 3 == (n or 0)) for n in (None, 1, 2)}
    assert {(r.n, tuple(r.v)) for r in got.select("n", "v").distinct().collect()} == {(n, tuple(v)) for n, v in want.items()}
    assert got.count() == 40_000 and got.rdd.getNumPartitions() == 4
