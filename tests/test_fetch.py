"""Fetching with transports that answer from lists."""

import json

import pytest

from mesaquery.sources import fetch
from mesaquery.sources.fetch import Response


def answers(*responses):
    left, asked = list(responses), []

    def send(*args):
        asked.append(args)
        r = left.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    send.asked = asked
    return send


def test_calls_are_paced():
    now, slept = [0.0], []
    sleep = lambda s: (slept.append(s), now.__setitem__(0, now[0] + s))
    paced = fetch.Paced(lambda x: Response(200, x), 1.0, lambda: now[0], sleep)
    assert paced(b"a").body == b"a" and not slept
    now[0] += 0.25
    paced(b"b")
    now[0] += 5
    paced(b"c")
    assert slept == [0.75]


def test_get_follows_moves_and_waits_once():
    slept = []
    send = answers(Response(308, headers={"Location": "/b"}), Response(429), Response(200, b"x" * 10))
    assert fetch.get("http://h/a", send, most_bytes=4, sleep=slept.append).body == b"xxxx"
    assert send.asked == [("http://h/a",), ("http://h/b",), ("http://h/b",)] and slept == [5.0]
    with pytest.raises(fetch.Refused):
        fetch.get("u", answers(Response(429), Response(429)), sleep=slept.append)
    with pytest.raises(fetch.Refused):
        fetch.get("u", answers(Response(404)))
    with pytest.raises(fetch.Refused):
        fetch.get("u", lambda u: Response(308, headers={"Location": "/again"}))


def test_refused_keys_are_found_anew_once():
    send = answers(Response(403), Response(200, b'{"n": 1}'))
    assert fetch.post("u", {}, "old", send, lambda: "new") == ({"n": 1}, "new") and [a[2] for a in send.asked] == ["old", "new"]
    with pytest.raises(fetch.Refused):
        fetch.post("u", {}, "old", answers(Response(403), Response(403)), lambda: "new")


def test_busy_services_are_asked_again():
    busy, slept = lambda a: a["status"] == "OVER", []
    assert fetch.ask(answers({"status": "OVER"}, OSError(), {"status": "OK"}), busy, sleep=slept.append) == {"status": "OK"} and slept == [2.0, 4.0]
    assert fetch.ask(answers(*[{"status": "OVER"}] * 3), busy, sleep=slept.append) == {"status": "OVER"}
    with pytest.raises(OSError):
        fetch.ask(answers(OSError(), OSError()), busy, tries=2, sleep=slept.append)


def test_pages_land_once_a_stamp(tmp_path):
    asked = []

    def page(n):
        asked.append(n)
        return {"items": [{"slug": f"{n}-{i}"} for i in range(2)], "total": 5}

    assert fetch.land_pages(tmp_path / "p", "2026-08-03", page) == 3 == fetch.land_pages(tmp_path / "p", "2026-08-03", page)
    assert asked == [1, 2, 3] and json.loads((tmp_path / "p" / "2.json").read_text())["items"][1] == {"slug": "2-1"}
    assert fetch.land_pages(f"file://{tmp_path}/p", "2026-08-03", page) == 3 and asked == [1, 2, 3]
    assert fetch.land_pages(tmp_path / "p", "2026-08-04", lambda n: {"items": []}) == 1 and [f.name for f in sorted((tmp_path / "p").iterdir())] == ["1.json", "_stamp"]


def test_rendered_pages():
    def render(url):
        if url == "bad":
            raise ValueError("no")
        return "text", ["a"]

    got = fetch.rendered(["ok", "bad"], render)
    assert got[0] == {"url": "ok", "text": "text", "hrefs": ["a"], "error": None} and got[1]["text"] == "" and got[1]["error"] == "ValueError: no"
