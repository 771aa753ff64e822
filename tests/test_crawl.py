"""HTTP client against a local server, and the git sink on a temporary repository."""

import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from paragrid.operators import gitlog
from paragrid.sources import http


@pytest.fixture(scope="module")
def server():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.path)
            tries = seen.count(self.path)
            if self.path.startswith("/busy") and tries < 3:
                self.send_response(503)
                self.end_headers()
                return
            if self.path.startswith("/gone"):
                self.send_response(404)
                self.end_headers()
                return
            body = b'{"results": {"bindings": [{"celex": {"value": "x"}}]}}' if self.path.startswith("/sparql") else b"seite"
            self.send_response(200)
            self.send_header("ETag", "v1")
            self.send_header("Last-Modified", "")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            if self.command == "GET":
                self.wfile.write(body)

        do_HEAD = do_GET

        def log_message(self, *_):
            pass

    own = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}", seen
    own.shutdown()


def test_requests_and_retries(server):
    base, seen = server
    slept = []
    client = http.Fetcher(sleep=slept.append)
    assert client.request(f"{base}/a")["body"] == b"seite"
    assert client.request(f"{base}/busy")["status"] == 200 and slept == [1.5, 3.0]
    gone = client.request(f"{base}/gone")
    assert (gone["status"], gone["body"]) == (404, None) and seen.count("/gone") == 1
    assert client.fingerprint(f"{base}/a") == {"etag": "v1", "content_length": "5"}
    assert client.sparql(f"{base}/sparql", "select *") == [{"celex": {"value": "x"}}]
    down = http.Fetcher(attempts=2, sleep=slept.append, timeout=1).request("http://127.0.0.1:1/")
    assert down["status"] is None and down["error"]
    with pytest.raises(OSError):
        http.Fetcher(attempts=1).sparql(f"{base}/gone", "x")


def test_rate_limit():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    limit = http.RateLimiter(delay=0.75, jitter=0, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        limit.wait()
    now[0] += 10
    limit.wait()
    assert slept == [0.75, 0.75]


def test_pages(server, spark):
    base, _ = server
    urls = spark.createDataFrame([(f"{base}/p{i}",) for i in range(3)] + [(f"{base}/gone2",)], "url string")
    got = {r["url"].rsplit("/", 1)[1]: r for r in http.fetch_pages(urls, lambda: http.Fetcher(attempts=1), tasks=2).collect()}
    assert bytes(got["p1"]["body"]) == b"seite" and got["p1"]["headers"]["etag"] == "v1" and got["gone2"]["status"] == 404


def test_git_sink(tmp_path):
    repo = str(tmp_path / "data")
    gitlog.init(repo)
    gitlog.init(repo)
    (tmp_path / "data" / "laws").mkdir()
    (tmp_path / "data" / "laws" / "ä b.md").write_text("eins")
    (tmp_path / "data" / "x.txt").write_text("x")
    assert gitlog.changes(repo, "laws/") == [("A", "laws/ä b.md")] and gitlog.head_file(repo, "x.txt") is None
    first = gitlog.commit(repo, "law(X): stand 2019-06-05", "2019-06-05", ["laws"])
    assert first and gitlog._git(repo, "log", "-1", "--format=%ad %cd %an %s", "--date=short").strip() == "2019-06-05 2019-06-05 corpus law(X): stand 2019-06-05"
    assert gitlog.changes(repo) == [("A", "x.txt")] and gitlog.commit(repo, "nichts", "2020-01-01", ["laws"]) is None
    (tmp_path / "data" / "laws" / "ä b.md").write_text("zwei")
    (tmp_path / "data" / "x.txt").unlink()
    assert gitlog.changes(repo) == [("M", "laws/ä b.md")] and gitlog.head_file(repo, "laws/ä b.md") == "eins"
    (tmp_path / "data" / "laws" / "ä b.md").unlink()
    assert gitlog.changes(repo) == [("D", "laws/ä b.md")]
    with pytest.raises(OSError):
        gitlog.changes(str(tmp_path))
