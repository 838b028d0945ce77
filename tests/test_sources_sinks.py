from __future__ import annotations

import json
import threading
import urllib.parse
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tallyloom.__main__ import main
from tallyloom.sinks import store
from tallyloom.sources import catalogues, collector, configs, http, manifests
from tallyloom.streaming import tail

ROW = {"task_id": "t1", "data_id": "d", "service": "S", "operation": "o", "endpoint_url": "https://x/o", "scope_strategy": "lookup_once", "raw_path": "data/raw/S/o/t1.xml", "sha256": "0" * 64, "bytes": 1, "collected_at": "2025-01-01T00:00:00Z", "http_status": 200, "result_code": "00", "total_count": 1, "row_count": 1, "column_count": 1, "field_names": ["v"], "duplicate_row_count": 0, "params": {"svyYr": "2025"}}


def lines(*rows, end="\n"):
    return "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + end


def test_strict_manifest(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text(lines(ROW, "", ROW | {"task_id": "0000027"}) + '{"task_id": "cut', encoding="utf-8")
    got = manifests.strict(spark, str(path)).orderBy("line_no").collect()
    assert [(r.line_no, r.task_id, r.params) for r in got] == [(1, "t1", {"svyYr": "2025"}), (3, "0000027", {"svyYr": "2025"})]
    for bad in ("{broken", json.dumps({k: v for k, v in ROW.items() if k != "sha256"})):
        path.write_text(lines(ROW, bad, ROW))
        with pytest.raises(Exception, match="corrupt manifest line 2"):
            manifests.strict(spark, str(path)).collect()
    path.write_text("")
    assert manifests.strict(spark, str(path)).collect() == []


def test_lenient_manifest(spark, rows, tmp_path):
    path = tmp_path / "m.jsonl"
    row = {"task_id": "a", "status": "downloaded", "local_path": "x", "sha256": "0", "size_bytes": 1}
    path.write_text(lines(row, row | {"local_path": "y"}, row | {"status": "failed", "local_path": "z"}, row | {"task_id": ""}, "{cut", end=""))
    assert rows(manifests.lenient(spark, str(path)), "task_id", "local_path") == [("a", "y")]
    path.write_text(lines(row, "{bad", row))
    with pytest.raises(Exception, match="corrupt manifest line 2"):
        manifests.lenient(spark, str(path)).collect()
    facts = manifests.facts(spark, str(path)).first()
    assert (facts.fact_size, facts.fact_digest) == store.file_facts(path)


def test_configs(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    with pytest.raises(ValueError):
        configs.load_json(str(tmp_path / "a.json"))
    (tmp_path / ".env").write_text("# KEY=no\nexport KEY = 'a%2Bb'\nOTHER=\n")
    assert configs.load_key(str(tmp_path / ".env"), "KEY") == "a+b"
    with pytest.raises(ValueError):
        configs.load_key(str(tmp_path / ".env"), "OTHER")
    assert configs.endpoints(spark, {"endpoints": [{"data_id": "0001", "output_fields": ["v"]}]}).first().data_id == "0001"
    groups = {"groups": {"41": {"domain": "x", "series": {"l": {"id": "s", "expected_files": 2}}}}}
    assert configs.expected_series(spark, groups).first().expected == 2


PAGE = """<ul><li>묶음<ul><li>2025 <span>2025</span><b> 학교별  통계 : </b><a onclick="download('f1', 'r1','2025년 a.xlsx','41')">x</a><a onclick="download('f2','r2','24년 b.xlsx','41')">y</a></li>
<li><a onclick="other('f')">z</a></li><li><a onclick="download('f3','r3','b.xlsx','42')">w</a></li></ul></li></ul>"""


def test_html_catalogue(spark, rows):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<li><li>")], "n int, page string")
    assert rows(catalogues.html_files(df, ["n"], "page"), "n", "label", "file_id", "display_name", "group_code", "file_year") == [
        (1, "w", "f3", "b.xlsx", "42", None), (1, "학교별 통계", "f1", "2025년 a.xlsx", "41", 2025), (1, "학교별 통계", "f2", "24년 b.xlsx", "41", 2024),
    ]


def test_json_catalogues(spark, rows):
    listed = {"aplList": [{"domnCd": "7", "eduDataSeNm": "s", "domnNm": "n", "pvsnYrNm": "2020\r\n2021"}, {"domnCd": ""}, None, {"domnNmOri": "x"}]}
    df = spark.createDataFrame([(json.dumps(listed),), (None,), ("broken",)], "payload string")
    assert rows(catalogues.json_datasets(df, "payload")) == [("s", "", "n", "7", "2020 2021", "")]
    files = catalogues.file_list(spark.createDataFrame([("7", json.dumps([{"atflYr": "2020", "atchFileSn": "1"}, None, {"atflYr": "2020", "atchFileSn": "2"}, {"atflYr": "ALL", "atchFileSn": None}]))], "code string, payload string"), ["code"], "payload")
    wanted = spark.createDataFrame([("7", "2020"), ("7", "ALL"), ("7", "1999")], "code string, file_year string")
    assert rows(catalogues.select_files(wanted, files, "code"), "file_year", "serial", "problem") == [("1999", None, "year not available"), ("2020", "1", None), ("ALL", None, "no serial")]


class Api(BaseHTTPRequestHandler):
    calls: list[str] = []
    total = 3

    def do_GET(self):
        query = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
        self.calls.append(self.path)
        if query.get("mode") == "flaky" and len([c for c in self.calls if "flaky" in c]) < 3:
            self.send_response(503)
            self.end_headers()
            return
        if query.get("mode") == "gone":
            self.send_response(404)
            self.end_headers()
            return
        if self.path.startswith("/landing"):
            self.send_response(200)
            self.send_header("Set-Cookie", "key=1; Path=/")
            self.end_headers()
            self.wfile.write(b"<ul><li>Label<a onclick=\"download('1','r','2024 d','g')\">2020</a></li></ul>")
            return
        total = int(query.get("total", "3"))
        items = "".join(f"<item><v>{n}</v></item>" for n in range(min(total, int(query.get("numOfRows", "99")))))
        body = "<broken>" if query.get("mode") == "broken" else f"<r><resultCode>00</resultCode><items>{items}</items><totalCount>{total}</totalCount></r>"
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body.encode())

    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        kind = self.headers["Content-Type"].split(";")[0]
        answer = {"/list": [{"atflYr": "2025", "atchFileSn": "7"}, 5, {"atflYr": "ALL"}], "/bad": {"x": 1}}.get(self.path, {"aplList": [{"domnCd": "1", "eduDataSeNm": self.headers.get("Cookie", "")}, {"domnCd": ""}]})
        if kind == "multipart/form-data":
            self.calls.append(body.decode())
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(answer).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def api():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/o"
    server.shutdown()


def test_http_source(spark, api):
    requests = [(m, http.request_url(api, {"mode": m, "serviceKey": "no"}, "serviceKey", "secret")) for m in ("fine", "flaky", "gone", "broken")]
    got = {r.task_id: r for r in http.responses(spark, requests, attempts=3, pause=0.01, concurrency=2).collect()}
    assert (got["fine"].http_status, got["fine"].attempts, got["fine"].error) == (200, 1, None)
    assert (got["flaky"].http_status, got["flaky"].attempts) == (200, 3)
    assert (got["gone"].http_status, got["gone"].attempts, got["gone"].error) == (404, 1, "status 404")
    assert (got["broken"].attempts, got["broken"].error) == (3, "not well-formed")
    assert all("secret" not in r.url for r in got.values())


def test_collect(spark, api, rows):
    data = [("three", api, {"total": "3"}, ["v"]), ("one", api, {"total": "1"}, ["v"]), ("none", api, {"total": "0"}, ["v"]), ("extra", api, {"total": "2"}, ["w"]), ("gone", api, {"mode": "gone"}, ["v"])]
    tasks = spark.createDataFrame(data, "task_id string, endpoint_url string, params map<string,string>, output_fields array<string>")
    got = rows(collector.collect(tasks), "task_id", "status", "failure", "requests", "item_count")
    assert got == [("extra", "failed", "undeclared fields", 2, None), ("gone", "failed", "unexpected status", 1, None), ("none", "stored", None, 1, 0), ("one", "stored", None, 1, 1), ("three", "stored", None, 2, 3)]
    with pytest.raises(collector.RowLimit):
        collector.collect_one(api, {"total": "9"}, row_limit=8)


def test_probe(spark, api, rows):
    data = [("S", "b", "lookup_once", api, None), ("S", "a", "nationwide_by_year", api, {"total": "0"}), ("S", "c", "lookup_once", api, {"mode": "gone"})]
    catalogue = spark.createDataFrame(data, "service string, operation string, scope_strategy string, endpoint_url string, fixed_params map<string,string>")
    got = [tuple(r) for r in collector.probe(catalogue, "2025", "1", "01").select("operation", "result_code", "total_count", "item_count", "error").collect()]
    assert got == [("a", "00", 0, 0, None), ("b", "00", 3, 1, None), ("c", None, None, None, "status 404")]
    assert collector.Policy().concurrency == 2
    for bad in ({"concurrency": 5}, {"attempts": 0}, {"timeout": -1}):
        with pytest.raises(ValueError):
            collector.Policy(**bad)


def test_forms():
    assert http.form({"a": "가"})[0] == b"a=%EA%B0%80"
    assert http.multipart({"a": "1"}, "X")[0] == b'--X\r\nContent-Disposition: form-data; name="a"\r\n\r\n1\r\n--X--\r\n'


def test_retry_after():
    class E:
        headers = {"Retry-After": "9999"}

    assert http.wait_of(E(), 0.5, 1) == 300.0 and http.wait_of(None, 0.5, 3) == 2.0


def test_store(tmp_path):
    source, manifest = tmp_path / "in", tmp_path / "log" / "m.jsonl"
    source.write_bytes(b"abc")
    assert store.save(source, tmp_path / "raw", "S/o/t.xml", manifest, {"task_id": "t"}) == "stored"
    assert store.save(source, tmp_path / "raw", "S/o/t.xml", manifest, {"task_id": "t"}) == "skipped"
    assert len(manifest.read_text().splitlines()) == 1
    source.write_bytes(b"other")
    with pytest.raises(store.PathConflict):
        store.save(source, tmp_path / "raw", "S/o/t.xml", manifest, {})
    assert (tmp_path / "raw/S/o/t.xml").read_bytes() == b"abc"
    with pytest.raises(ValueError):
        store.save(source, tmp_path / "raw", "../x", manifest, {})
    with pytest.raises(store.IntegrityError):
        store.publish_file(source, tmp_path / "y", sha256="0")
    with pytest.raises(ValueError):
        store.save(source, tmp_path / "raw", "S/o/new.xml", manifest, {"n": float("nan")})
    assert not (tmp_path / "raw/S/o/new.xml").exists()
    manifest.write_bytes(b'{"cut')
    store.append_line(manifest, {"a": "가"})
    assert manifest.read_text().splitlines() == ['{"a": "가"}']
    source.write_bytes(b"  <HTML>")
    with pytest.raises(store.IntegrityError, match="HTML"):
        store.publish_response(source, tmp_path / "z")
    source.write_bytes(b"")
    with pytest.raises(store.IntegrityError):
        store.publish_response(source, tmp_path / "z")
    assert not list((tmp_path / "raw").rglob("*.part"))
    with pytest.raises(ValueError):
        store.raw_path("S", "o/..", "t")


def test_archives(tmp_path):
    book = tmp_path / "b.xlsx"
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("[Content_Types].xml", "x")
        z.writestr("xl/workbook.xml", "y")
    store.check_archive(book, "xlsx")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("a", "x" * 50)
    store.check_archive(tmp_path / "c.zip", "zip")
    with pytest.raises(store.IntegrityError, match="workbook"):
        store.check_archive(tmp_path / "c.zip", "xlsx")
    data = bytearray((tmp_path / "c.zip").read_bytes())
    data[40] ^= 1
    (tmp_path / "d.zip").write_bytes(data)
    with pytest.raises(store.IntegrityError):
        store.check_archive(tmp_path / "d.zip", "zip")
    (tmp_path / "e").write_text("<html>")
    with pytest.raises(store.IntegrityError):
        store.check_archive(tmp_path / "e", "zip")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S", "o", "t", "late"), ("S", "p/", "u", "late")], "service string, operation string, task_id string, failure string")
    assert [r[0] for r in df.select(store.raw_paths(F.col("service"), F.col("operation"), F.col("task_id"))).collect()] == ["data/raw/S/o/t.xml", None]
    store.quarantine(df, str(tmp_path / "q"))
    store.quarantine(df, str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).count() == 4
    store.write_partitioned(df, str(tmp_path / "w"), "service")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.write_partitioned(df, str(tmp_path / "w"), "service")


def test_stream(spark, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.jsonl").write_text(lines(ROW, ROW, ROW | {"task_id": "t2"}, ROW | {"task_id": "t3", "collected_at": "n/a"}))
    run = lambda: tail.run_once(tail.tail(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "state"))
    run()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "task_id") == [("t1",), ("t2",)]
    (folder / "2.jsonl").write_text(lines(ROW, ROW | {"task_id": "t4", "collected_at": "2025-01-20T00:00:00Z"}))
    run()
    run()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "task_id") == [("t1",), ("t2",), ("t4",)]
    static = spark.createDataFrame([("S", 5)], "service string, bytes long").withColumn("event_time", F.lit("2025-01-01 10:00:00").cast("timestamp"))
    assert tail.counts(static, ["service"]).select("service", "rows", "bytes").first() == ("S", 1, 5)


def test_stream_late_and_undated_rows(spark, rows, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    late = ROW | {"task_id": "late", "collected_at": "2024-06-01T00:00:00Z"}
    undated = ROW | {"task_id": "undated", "collected_at": "n/a"}
    for n, text in enumerate([lines(ROW, undated, undated, "{broken"), lines(ROW | {"task_id": "new", "collected_at": "2025-12-01T00:00:00Z"}), lines(late, undated), lines(late, ROW)]):
        (folder / f"{n}.jsonl").write_text(text)
        tail.run_once(tail.tail(spark, str(folder)), out, str(tmp_path / "state"))
    assert rows(spark.read.parquet(out), "task_id") == [("late",), ("new",), ("t1",)]
    assert rows(spark.read.parquet(f"{out}-quarantine"), "task_id", "_corrupt_record") == sorted([("undated", None), (None, "{broken")], key=repr)
    with pytest.raises(ValueError, match="log of the file sink"):
        (tmp_path / "old" / "_spark_metadata").mkdir(parents=True)
        tail.run_once(tail.tail(spark, str(folder)), str(tmp_path / "old"), str(tmp_path / "state2"))


def test_command_line(spark, capsys, tmp_path):
    catalogue = {"endpoints": [{"data_id": "d", "service": "S", "operation": "o", "scope_strategy": "nationwide_by_year", "endpoint_url": "https://x/o", "output_fields": ["v"]}]}
    (tmp_path / "c.json").write_text(json.dumps(catalogue))
    assert main(["plan", "--catalogue", str(tmp_path / "c.json"), "--year", "2025", "--year", "2024", "--limit", "1"]) == 0
    task = json.loads(capsys.readouterr().out)
    assert task["params"] == {"svyYr": "2024"}
    (tmp_path / "m.jsonl").write_text(lines(ROW | {"task_id": task["task_id"]}))
    assert main(["plan", "--catalogue", str(tmp_path / "c.json"), "--year", "2025", "--year", "2024", "--manifest", str(tmp_path / "m.jsonl")]) == 0
    assert json.loads(capsys.readouterr().out)["params"] == {"svyYr": "2025"}
    assert main(["plan", "--catalogue", str(tmp_path / "c.json"), "--year", "25"]) == 1
    assert main(["query", "nothing", str(tmp_path)]) == 1


def test_save_resumes(tmp_path):
    one, other, manifest, root = tmp_path / "one", tmp_path / "other", tmp_path / "m.jsonl", tmp_path / "raw"
    one.write_text("a")
    other.write_text("b")
    (root / "S").mkdir(parents=True)
    (root / "S" / "there.xml").write_text("a")
    assert store.save(one, root, "S/there.xml", manifest, {"task_id": "t"}) == "adopted"
    assert store.save(one, root, "S/there.xml", manifest, {"task_id": "t"}) == "skipped"
    assert len(manifest.read_text().splitlines()) == 1
    with pytest.raises(store.TaskConflict):
        store.save(other, root, "S/there.xml", manifest, {"task_id": "t"})
    (root / "S" / "there.xml").write_text("changed")
    with pytest.raises(store.IntegrityError):
        store.save(one, root, "S/there.xml", manifest, {"task_id": "t"})
    with pytest.raises(store.IntegrityError):
        store.save(one, root, "S/new.xml", manifest, {"task_id": "u"}, sha256="0" * 64)
    assert not (root / "S" / "new.xml").exists()


def test_log_reads_on_and_sees_tampering(tmp_path):
    path = tmp_path / "m.jsonl"
    log = store.Log(path)
    log.refresh()
    log.add({"task_id": "a", "n": 1})
    with open(path, "a") as f:
        f.write('{"task_id": "a", "n": 2}\n\n{"task_id": "b"')
    log.refresh()
    assert [r["n"] for r in log.rows("a")] == [1, 2] and log.rows("b") == []
    log.add({"task_id": "b", "n": 3})
    assert [r["n"] for r in log.rows("b")] == [3]
    whole = path.read_bytes()
    path.write_bytes(whole[:-5])
    with pytest.raises(store.IntegrityError, match="cut"):
        log.refresh()
    (tmp_path / "new").write_bytes(whole)
    (tmp_path / "new").replace(path)
    with pytest.raises(store.IntegrityError, match="replaced"):
        log.refresh()
    path.unlink()
    with pytest.raises(store.IntegrityError, match="gone"):
        log.refresh()
    path.write_text("[1]\n")
    with pytest.raises(store.IntegrityError, match="bad line"):
        store.Log(path).refresh()


def test_archives_of_a_store(spark, rows, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x", "content")
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("[Content_Types].xml", "t")
    (tmp_path / "c.zip").write_text("no archive")
    broken = bytearray((tmp_path / "a.zip").read_bytes())
    broken[31] ^= 1  # within the stored content
    (tmp_path / "d.zip").write_bytes(broken)
    (tmp_path / "e.xml").write_text("<r/>")
    found = {path.rsplit("/", 1)[1]: problem for path, _, problem in rows(store.archive_findings(spark, str(tmp_path), {"zip": "zip", "xlsx": "xlsx"}))}
    assert found["a.zip"] is None and found["e.xml"] is None and found["b.xlsx"] == "lacks xl/workbook.xml" and found["c.zip"] == "not a zip archive" and found["d.zip"].startswith("x: ")
    with pytest.raises(ValueError):
        store.archive_problem(tmp_path / "a.zip", "rar")


def test_session(spark, rows, api, tmp_path):
    import io

    base = api.removesuffix("/o")
    session = http.Session(pause=0.01)
    got = catalogues.fetch_datasets(spark, session, f"{base}/landing", f"{base}/catalogue", {"q": ""})
    assert rows(got, "source", "domn_code") == [("key=1", "1")]
    assert rows(catalogues.fetch_file_list(spark, session, f"{base}/list", "1"), "domn_code", "position", "file_year", "serial") == [("1", 0, "2025", "7"), ("1", 2, "ALL", None)]
    for wrong in (lambda: catalogues.fetch_datasets(spark, session, f"{base}/landing", f"{base}/bad", {}), lambda: catalogues.fetch_file_list(spark, session, f"{base}/bad", "1")):
        with pytest.raises(ValueError, match="gave no list"):
            wrong()
    assert rows(catalogues.fetch_page(spark, session, f"{base}/landing"), "label", "file_id", "file_year") == [("Label", "1", 2024)]
    session.submit(f"{base}/poll", {"TYPE": "a"})
    assert any('name="TYPE"' in c for c in Api.calls)
    stream = io.BytesIO()
    facts = session.download(f"{api}?total=2", stream)
    assert facts["bytes"] == len(stream.getvalue()) > 0 and facts["http_status"] == 200
    with pytest.raises(http.urllib.error.HTTPError):
        session.text(f"{api}?mode=gone")


def test_streamed_download(api, tmp_path):
    one = http.download_xml(f"{api}?total=5", tmp_path, pause=0.01)
    assert one["error"] is None and store.file_facts(one["path"]) == (one["bytes"], one["sha256"])
    assert http.download_xml(f"{api}?mode=broken", tmp_path, pause=0.01) | {"path": None} == http.download_xml(f"{api}?mode=broken", tmp_path, pause=0.01)
    assert http.download_xml(f"{api}?mode=gone", tmp_path)["error"] == "status 404" and len(list(tmp_path.iterdir())) == 1


def test_planned_responses(spark, api, rows):
    asked = spark.createDataFrame([("a", f"{api}?total=1&serviceKey=s"), ("b", f"{api}?mode=gone")], "task_id string, url string").withColumn("error", F.lit("clash"))
    got = rows(http.planned_responses(asked, pause=0.01), "task_id", "url", "http_status", "error")
    assert got == [("a", api, 200, None), ("b", api, 404, "status 404")]


def test_row_limit_keeps_the_rest(spark, api, rows):
    tasks = spark.createDataFrame([("a", api, {"total": "2"}, None), ("b", api, {"total": "9"}, None), ("c", api, {"total": "1"}, None)], "task_id string, endpoint_url string, params map<string,string>, output_fields array<string>")
    got = collector.collect(tasks, 1, row_limit=5).cache()
    assert [s for _, s in rows(got, "task_id", "status")] == ["stored", "failed", "stored"]
    with pytest.raises(collector.RowLimit, match="b: "):
        collector.within_limits(got)
    assert collector.within_limits(got.filter("task_id <> 'b'")).count() == 2


def test_schools(spark, rows):
    xml = lambda year, *ids, total=None: f"<r><resultCode>00</resultCode><items>{''.join(f'<item><schlId>{i}</schlId><svyYr>{year}</svyYr></item>' for i in ids)}</items><totalCount>{len(ids) if total is None else total}</totalCount></r>"
    stored = spark.createDataFrame([("2025", xml("2025", "0000027", "0000014")), ("1999", xml("1999", "1"))], "svyYr string, payload string")
    assert rows(collector.schools(["2025"], stored)) == [("2025", "0000014"), ("2025", "0000027")]
    with pytest.raises(ValueError, match="2024"):
        collector.schools(["2025", "2024"], stored)
    assert ("2024", "5") in rows(collector.schools(["2025", "2024"], stored, lambda year: {"payload": xml(year, "5")}))
    for bad in (xml("2023", "5"), xml("2024", "5", "5"), xml("2024", "5", total=2), xml("2024", "")):
        with pytest.raises(ValueError, match="unusable"):
            collector.schools(["2024"], stored, lambda year, bad=bad: {"payload": bad})


def test_policy_of_a_configuration():
    config = {"default_concurrency": 2, "max_concurrency": 4, "probe_page_size": 1, "single_page": {"max_verified_rows": 70000}}
    assert collector.Policy.of(config, concurrency=3, attempts=None) == collector.Policy(concurrency=3)
    for bad in ({}, config | {"single_page": None}, {k: v for k, v in config.items() if k != "max_concurrency"}):
        with pytest.raises(ValueError):
            collector.Policy.of(bad)


def test_run_and_resume(spark, api, capsys, tmp_path):
    endpoint = lambda op, **fixed: {"data_id": "d", "service": "S", "operation": op, "scope_strategy": "lookup_once", "endpoint_url": api, "output_fields": ["v"], "fixed_params": fixed}
    (tmp_path / "c.json").write_text(json.dumps({"endpoints": [endpoint("fine", total="2"), endpoint("gone", mode="gone")]}))
    args = ["--catalogue", str(tmp_path / "c.json"), "--manifest", str(tmp_path / "m.jsonl")]
    assert main(["run", *args, "--store", str(tmp_path / "raw")]) == 2
    told = json.loads(capsys.readouterr().out)
    assert (told["planned"], told["stored"], told["failed"], told["skipped"]) == (2, 1, 1, 0) and told["failures"][0]["failure"] == "unexpected status"
    row = json.loads((tmp_path / "m.jsonl").read_text())
    assert store.file_facts(tmp_path / "raw" / row["raw_path"]) == (row["bytes"], row["sha256"]) and row["field_names"] == ["v"] and row["row_count"] == 2
    assert main(["resume", *args]) == 0
    assert [json.loads(x)["operation"] for x in capsys.readouterr().out.splitlines()] == ["gone"]
    (tmp_path / "c.json").write_text(json.dumps({"endpoints": [endpoint("fine", total="2")]}))
    assert main(["run", *args, "--store", str(tmp_path / "raw")]) == 0
    assert json.loads(capsys.readouterr().out)["skipped"] == 1
    assert main(["plan", *args, "--school", "2025:27"]) == 1


def test_progress_is_told(spark):
    import time

    from tallyloom.session import telling

    told = []
    slow = spark.range(0, 4, 1, 2).rdd.map(lambda r: time.sleep(0.4) or r)
    with telling(spark, told.append, 0.1):
        assert slow.count() == 4
    assert any(" of 2 done" in t for t in told)
    with telling(spark, told.append, 0.1):
        pass
