"""Polite HTTP for crawlers: retries with backoff, a rate limit, and pages as a DataFrame.

The engine itself reads files; this fetches them.  It uses the standard library
only, takes its clock and its opener as arguments, and never raises for a page.
"""

from __future__ import annotations

import json
import random
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

#: Statuses worth another try, attempts and backoff of the published session.
RETRIED = frozenset((429, 500, 502, 503, 504))
ATTEMPTS, BACKOFF, TIMEOUT = 5, 1.5, 30.0
PAGES = "url string, status int, headers map<string,string>, body binary, error string"


@dataclass
class RateLimiter:
    """At least ``delay`` seconds and up to ``jitter`` more between two requests, for all threads that share it."""

    delay: float = 0.75
    jitter: float = 0.5
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _next: float = 0.0

    def wait(self) -> None:
        with self._lock:
            now = self.clock()
            if now < self._next:
                self.sleep(self._next - now)
            self._next = max(now, self._next) + self.delay + random.uniform(0, self.jitter)


@dataclass
class Fetcher:
    """One client: a user agent, retries, a shared limiter."""

    user_agent: str = "paragrid"
    attempts: int = ATTEMPTS
    backoff: float = BACKOFF
    timeout: float = TIMEOUT
    limiter: RateLimiter | None = None
    opener: Callable = urllib.request.urlopen
    sleep: Callable[[float], None] = time.sleep

    def request(self, url: str, *, method: str = "GET", headers: dict[str, str] | None = None) -> dict:
        """url, status, headers (lower case), body and error; the last answer if all attempts fail."""
        out: dict = {"url": url, "status": None, "headers": {}, "body": None, "error": None}
        for attempt in range(max(1, self.attempts)):
            if attempt:
                self.sleep(self.backoff * 2 ** (attempt - 1))
            if self.limiter:
                self.limiter.wait()
            sent = urllib.request.Request(url, method=method, headers={"User-Agent": self.user_agent, **(headers or {})})
            try:
                with self.opener(sent, timeout=self.timeout) as answer:
                    return out | {"status": answer.status, "headers": {k.lower(): v for k, v in answer.headers.items()}, "body": answer.read(), "error": None}
            except urllib.error.HTTPError as e:
                out |= {"status": e.code, "headers": {k.lower(): v for k, v in e.headers.items()}, "error": f"HTTP {e.code}"}
                if e.code not in RETRIED:
                    return out
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                out["error"] = str(e)
        return out

    def fingerprint(self, url: str) -> dict[str, str]:
        """What a HEAD request says of a file's version, without empty values."""
        found = self.request(url, method="HEAD")["headers"]
        named = {"etag": "etag", "last_modified": "last-modified", "content_length": "content-length"}
        return {k: found[h] for k, h in named.items() if found.get(h)}

    def sparql(self, endpoint: str, query: str) -> list[dict]:
        """Bindings of a SPARQL query over GET; an answer that is no result raises."""
        url = f"{endpoint}?{urllib.parse.urlencode({'query': query, 'format': 'application/sparql-results+json'})}"
        answer = self.request(url, headers={"Accept": "application/sparql-results+json"})
        if answer["error"] or answer["body"] is None:
            raise OSError(answer["error"] or "no answer")
        return json.loads(answer["body"])["results"]["bindings"]


def fetch_pages(urls: DataFrame, make: Callable[[], Fetcher] = Fetcher, *, tasks: int = 1) -> DataFrame:
    """``urls`` (url) to ``PAGES``; each task has its own limiter, so ``tasks`` times its rate is the whole rate."""
    kinds = (pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string())
    names = ("url", "status", "headers", "body", "error")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        for batch in batches:
            for url in batch.column(0).to_pylist():
                row = client.request(url)
                row["headers"] = list(row["headers"].items())
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in zip(names, kinds, strict=True)], names)

    return urls.select("url").repartition(tasks).mapInArrow(run, PAGES)
