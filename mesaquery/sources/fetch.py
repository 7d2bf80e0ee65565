"""Ingest from the network, outside of Spark: paced, retried and cached. Transports are parameters.

Pages and documents land as files, which the readers take from there; no fetch runs inside a query.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urljoin

from pyarrow.fs import FileSelector, FileSystem, LocalFileSystem


@dataclass(frozen=True)
class Response:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


class Refused(Exception):
    """A response of a status that isn't expected."""

    def __init__(self, url: str, status: int):
        super().__init__(f"{status} for {url}")
        self.status = status


class Paced:
    """A transport with at least ``pause`` seconds between the starts of its calls."""

    def __init__(self, send: Callable[..., Response], pause: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.send, self.pause, self.clock, self.sleep = send, pause, clock, sleep
        self.last: float | None = None

    def __call__(self, *args, **kwargs) -> Response:
        if self.last is not None and (wait := self.last + self.pause - self.clock()) > 0:
            self.sleep(wait)
        self.last = self.clock()
        return self.send(*args, **kwargs)


def get(url: str, send: Callable[[str], Response], most_bytes: int = 2_000_000, moves: int = 5, pause: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> Response:
    """The document at ``url``, cut at ``most_bytes``: follows permanent moves, waits once for a busy host."""
    waited = False
    for _ in range(moves + 2):
        got = send(url)
        if got.status == 308 and got.headers.get("Location"):
            url = urljoin(url, got.headers["Location"])
        elif got.status == 429 and not waited:
            waited = True
            sleep(pause)
        elif 200 <= got.status < 300:
            return Response(got.status, got.body[:most_bytes], got.headers)
        else:
            raise Refused(url, got.status)
    raise Refused(url, 308)


def post(url: str, body: dict, key: str, send: Callable[[str, dict, str], Response], find_key: Callable[[], str]) -> tuple[dict, str]:
    """The answer to a keyed request and the key that served: a refused key is looked up anew, once."""
    got = send(url, body, key)
    if got.status == 403:
        key = find_key()
        got = send(url, body, key)
    if got.status != 200:
        raise Refused(url, got.status)
    return json.loads(got.body), key


def ask(send: Callable[[], dict], busy: Callable[[dict], bool], tries: int = 3, pause: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A service's answer; a busy one, or one that can't be reached, is asked again after growing pauses."""
    for n in range(tries):
        last = n == tries - 1
        try:
            answer = send()
        except OSError:
            if last:
                raise
        else:
            if last or not busy(answer):
                return answer
        sleep(pause * (n + 1))
    raise ValueError("tries must be positive")


def land_pages(folder: str | Path, stamp: str, page: Callable[[int], dict]) -> int:
    """Land all pages of a listing as ``<n>.json`` and return how many; those of the same stamp aren't asked for again.

    ``folder`` is a local path or a URI of a store that executors share. Ends when the items reach the
    listing's total, or with an empty page.
    """
    fs, at = FileSystem.from_uri(str(folder)) if "://" in str(folder) else (LocalFileSystem(), str(folder))
    fs.create_dir(at, recursive=True)

    def read(name: str) -> str:
        with fs.open_input_stream(f"{at}/{name}") as file:
            return file.read().decode()

    def write(name: str, text: str) -> None:
        with fs.open_output_stream(f"{at}/{name}.new") as file:
            file.write(text.encode())
        fs.move(f"{at}/{name}.new", f"{at}/{name}")  # a file is there as a whole or not at all

    there = {f.base_name for f in fs.get_file_info(FileSelector(at))}
    if "_stamp" not in there or read("_stamp").strip() != stamp:
        for old in there:
            fs.delete_file(f"{at}/{old}")
        there = set()
        write("_stamp", stamp)
    items, n = 0, 0
    while True:
        name = f"{n + 1}.json"
        if name not in there:
            write(name, json.dumps(page(n + 1)))
        found = json.loads(read(name))
        n, items = n + 1, items + len(found.get("items") or ())
        if not found.get("items") or items >= (found.get("total") or 0):
            return n


def rendered(urls: Iterable[str], render: Callable[[str], tuple[str, list[str]]]) -> list[dict]:
    """url, text, hrefs and error of pages that a browser has rendered; a page that fails is empty."""
    out = []
    for url in urls:
        try:
            text, hrefs = render(url)
            out.append({"url": url, "text": text, "hrefs": list(hrefs), "error": None})
        except Exception as e:  # any fault of a page
            out.append({"url": url, "text": "", "hrefs": [], "error": f"{type(e).__name__}: {e}"})
    return out
