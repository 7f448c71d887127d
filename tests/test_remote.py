"""Remote records from a server on this machine that fails, refuses and limits."""

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.error import HTTPError
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from pairloom.sources import remote


@pytest.fixture
def server():
    """Knows ids that start with P; answers every third request with 503 or 429, and refuses batches that hold `bad`."""
    asked, times, lock = [], [], threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            ids = parse_qs(urlparse(self.path).query)["accessions"][0].split(",")
            with lock:
                times.append(time.monotonic())
                n = len(times)
                if n % 3 == 1:
                    code = 503 if n % 2 else 429
                else:
                    code = 400 if "bad" in ids else 410 if "fatal" in ids else 200
                if code == 200:
                    asked.extend(ids)
            self.send_response(code)
            if code == 429:
                self.send_header("Retry-After", "0")
            self.end_headers()
            if code == 200:
                self.wfile.write("".join(f">sp|{i}|N x\nMK{i}\nA\n" for i in ids if i.startswith("P")).encode())

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/find", asked, times
    s.shutdown()


def test_records_are_fetched_once_through_failures(spark, tmp_path, server):
    url, asked, times = server
    fetch = remote.by_http(url, "accessions", remote.fasta_values, 10.0, format="fasta")
    names = [f"P{k}" for k in range(53)] + ["Q1", "Q2", "bad"]
    ids = spark.createDataFrame([(i,) for i in [*names, "P1", "", None]], "id string")
    get = lambda x, **kw: {r.id: r.value for r in remote.fetch_missing(x, "id", f"{tmp_path}/cache", fetch, batch=10, ask_again=False, tasks=3, pause=0.01, **kw).collect()}
    want = {i: f"MK{i}A" for i in names if i.startswith("P")}
    assert get(ids) == want and sorted(asked) == sorted(set(names) - {"bad"})
    before = len(times)
    assert get(ids) == want and len(times) == before  # what isn't known is known to be so
    more = ids.union(spark.createDataFrame([("P99",)], "id string"))
    assert get(more) == want | {"P99": "MKP99A"} and asked[-1] == "P99"
    assert get(more.where("id = 'none'")) == {}


def test_rates_hold_and_other_failures_end_the_job(spark, tmp_path, server):
    url, asked, times = server
    fetch = remote.by_http(url, "accessions", remote.fasta_values, 10.0)
    ids = spark.range(12).select(F.concat(F.lit("P"), "id").alias("id"))
    got = remote.fetch_missing(ids, "id", f"{tmp_path}/a", fetch, batch=1, tasks=2, rate=10.0, pause=0.01)
    assert got.count() == 12 and len(asked) == 12
    assert all(times[k + 4] - times[k] > 0.1 for k in range(len(times) - 4))  # two tasks, each 0.2 s between its own
    with pytest.raises(Exception, match="410"):
        remote.fetch_missing(spark.createDataFrame([("fatal",)], "id string"), "id", f"{tmp_path}/b", fetch, pause=0.01)
    with pytest.raises(HTTPError):
        remote.patient(fetch, ["fatal"], 2, 0.01, lambda: None)
    assert remote.fetch_missing(ids.limit(0), "id", f"{tmp_path}/c", fetch).collect() == []
    assert remote.fasta_values("") == {} and remote.fasta_values(">a b\nM K\n\nL\n>x|y|z\n") == {"a": "MKL", "y": ""}


def test_commands_fetch_and_generate(spark, tmp_path, server):
    from pairloom.__main__ import main
    from pairloom.operators import generation
    from pairloom.plans.host_queries import _rule_step
    from pairloom.sources import readers

    (tmp_path / "ids.csv").write_text("id\nP1\nQ2\nP3\n")
    assert main(["fetch-sequences", f"{tmp_path}/ids.csv", server[0], f"{tmp_path}/cache", f"{tmp_path}/out.csv", "--batch", "2", "--rate", "100"]) == 0
    got = {r.id: r.sequence for r in readers.read_delimited(spark, f"{tmp_path}/out.csv").collect()}
    assert got == {"P1": "MKP1A", "P3": "MKP3A"}
    generation.register_generator("by-rule", _rule_step)
    assert main(["structure-letters", f"{tmp_path}/out.csv", "by-rule", f"{tmp_path}/letters", "--beams", "3", "--seed", "4"]) == 0
    letters = {r.id: r.letters for r in spark.read.parquet(f"{tmp_path}/letters").collect()}
    assert {k: len(v) for k, v in letters.items()} == {"P1": 5, "P3": 5}
    with pytest.raises(SystemExit):
        main(["structure-letters", f"{tmp_path}/out.csv", "none", f"{tmp_path}/letters"])
