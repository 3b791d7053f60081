"""The load test from filling to report, and its HTTP surface."""

import json
import threading
import time
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from keelson import loadtest
from keelson.http_api import Api, serve, sync_parameters
from keelson.jobs import BadParameters
from keelson.operators.seed import plan_rows
from keelson.sources.files import Files


def test_load_test(spark, tmp_path):
    root = f"file://{tmp_path}/lt"
    m, checks = loadtest.run_loadtest(spark, root, plan_rows(rows={"Customers": 120, "Orders": 300, "OrderItems": 500, "Products": 40, "Payments": 80}), batch=1000, min_rows_per_partition=50, snapshot_partitions=3)
    assert [t.stage for t in m.stages] == ["generate", "sync", "validate"] and [t.rows for t in m.stages[:2]] == [1040, 1040] and all(t.seconds > 0 for t in m.stages)
    assert {t["table_key"]: (t["source_rows"], t["target_rows"], t["match"]) for t in m.tables}["dbo.OrderItems"] == (500, 500, True)
    assert len(checks) == 25 and all(c["match"] for c in checks)
    files = Files(spark)
    assert json.loads(files.read(loadtest.write_json(spark, m, checks, f"{root}/reports")))["validation"] == checks
    assert "| dbo.Orders | 300 | 300 | True |" in files.read(loadtest.write_markdown(spark, m, checks, f"{root}/reports"))


def test_stats_of_tables(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    spark.range(100).select(F.col("id").alias("OrderId")).repartition(3).write.parquet(f"{root}/Orders")
    spark.range(7).select(F.col("id").alias("CustomerId")).write.parquet(f"{root}/Customers")
    source = loadtest.seeded_source(spark, root)
    source.floors["dbo.Customers"] = None
    got = {r["table_key"]: r for r in source.stats().collect()}
    assert (got["dbo.Orders"]["rows"], got["dbo.Orders"]["files"], got["dbo.Orders"]["tracked"]) == (100, 3, True)
    assert (got["dbo.Customers"]["rows"], got["dbo.Customers"]["tracked"]) == (7, False) and got["dbo.Customers"]["bytes"] > 0


def test_parameters():
    assert sync_parameters({})["batchSize"] == 100_000
    with pytest.raises(BadParameters, match="workers must be a whole number between 1 and 64\nresetTarget"):
        sync_parameters({"workers": 65, "resetTarget": "no"})


def test_http(spark, tmp_path):
    server = serve(Api(spark, f"file://{tmp_path}/api"), 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def ask(method, path, body=None):
        data = None if body is None else body if isinstance(body, bytes) else json.dumps(body).encode()
        r = urllib.request.Request(f"http://127.0.0.1:{server.server_port}{path}", data, method=method)
        try:
            with urllib.request.urlopen(r, timeout=120) as out:
                return out.status, out.headers, json.loads(out.read())
        except urllib.error.HTTPError as e:
            return e.code, e.headers, json.loads(e.read())

    def ended(location):
        for _ in range(600):
            job = ask("GET", location)[2]
            if job["status"] not in ("running", "cancelling"):
                return job
            time.sleep(0.2)
        raise AssertionError(job)

    try:
        assert ask("GET", "/health")[0] == 200
        assert [t["exists"] for t in ask("GET", "/schema")[2]] == [False] * 5
        assert [(t["rows"], t["changeTracking"]) for t in ask("POST", "/schema", {})[2]] == [(0, True)] * 5
        for body in ({"totalRows": 0}, {"rows": {"Nope": 1}}, {"batchSize": 5}, b"{", [1]):
            assert ask("POST", "/seed", body)[0] == 400
        status, headers, answer = ask("POST", "/seed", {"rows": {"Customers": 30, "Products": 10, "Orders": 60, "OrderItems": 90, "Payments": 20}, "batchSize": 1000})
        assert status == 202 and headers["Location"] == f"/jobs/{answer['jobId']}" and answer["plan"]["Orders"] == 60
        assert ask("POST", "/sync", {})[0] == 409
        assert ended(headers["Location"])["status"] == "succeeded"
        assert ask("POST", "/sync", {"workers": 0})[0] == 400
        status, headers, answer = ask("POST", "/sync", {"minRowsPerPartition": 1000})
        assert status == 202 and answer["settings"]["batchSize"] == 100_000
        job = ended(headers["Location"])
        assert job["status"] == "succeeded", job
        assert job["result"]["allRowCountsMatch"] and job["result"]["totalRows"] == 210 and len(job["result"]["tables"]) == 5
        assert [j["type"] for j in ask("GET", "/jobs")[2]] == ["sync", "seed"]
        assert ask("POST", f"{headers['Location']}/cancel")[0] == 409 and ask("GET", "/jobs/none")[0] == 404 and ask("GET", "/nowhere")[0] == 404 and ask("POST", "/health", {})[0] == 405
        assert {t["table"]: t["rows"] for t in ask("GET", "/schema")[2]} == {"Customers": 30, "Products": 10, "Orders": 60, "OrderItems": 90, "Payments": 20}
        assert "POST /sync" in " ".join(ask("GET", "/docs")[2])
    finally:
        server.shutdown()
