"""XML responses over HTTP as a Spark data source: ``spark.read.format("api")``.

One input partition per group of requests, so the number of partitions bounds the requests in
flight. Each request is tried several times, with growing pauses, for statuses that pass and for
bodies that are not well-formed; what still fails is a row with ``error``, not the end of the job.
"""

from __future__ import annotations

import contextlib
import hashlib
import http.client
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Any, BinaryIO
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Statuses worth another try.
PASSING = {408, 425, 429, 500, 502, 503, 504}
#: Bytes that are taken from a response at a time.
PIECE = 1 << 16
SCHEMA = "task_id string, url string, http_status int, bytes long, sha256 string, attempts int, payload string, error string"


def request_url(endpoint: str, params: dict[str, str], key_name: str | None = None, key: str | None = None, repeated: dict[str, list[str]] | None = None) -> str:
    """The address of a request: parameters sorted by name, repeated ones after them, the key last."""
    pairs = [(k, v) for k, v in sorted(params.items()) if k != key_name]
    pairs += [(k, v) for k, values in sorted((repeated or {}).items()) for v in values]
    return endpoint + "?" + urllib.parse.urlencode(pairs + ([(key_name, key)] if key_name and key else []))


def well_formed(text: str) -> bool:
    try:
        expat.ParserCreate().Parse(text, True)
    except expat.ExpatError:
        return False
    return True


def wait_of(error: urllib.error.HTTPError | None, pause: float, attempt: int, longest: float = 300.0) -> float:
    """The seconds before the next attempt: what the server asks for, else ``pause`` doubled each time."""
    asked = error.headers.get("Retry-After", "") if error is not None and error.headers else ""
    return min(float(asked), longest) if asked.isdigit() else pause * 2 ** (attempt - 1)


class Session:
    """Requests that keep the cookies of a host, with several tries for statuses that pass and for broken connections."""

    def __init__(self, attempts: int = 3, pause: float = 0.5, timeout: float = 180.0, agent: str = "tallyloom") -> None:
        self.attempts, self.pause, self.timeout = attempts, pause, timeout
        self.opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor())
        self.opener.addheaders = [("User-Agent", agent)]

    def open(self, url: str, data: bytes | None = None, headers: dict[str, str] | None = None) -> http.client.HTTPResponse:
        """The open response; what still fails after the last try is raised."""
        for attempt in range(1, self.attempts + 1):
            try:
                return self.opener.open(urllib.request.Request(url, data, headers or {}), timeout=self.timeout)
            except OSError as e:  # an HTTPError is one
                status = e if isinstance(e, urllib.error.HTTPError) else None
                if attempt == self.attempts or (status is not None and status.code not in PASSING):
                    raise
                time.sleep(wait_of(status, self.pause, attempt))
        raise AssertionError

    def text(self, url: str, data: bytes | None = None, headers: dict[str, str] | None = None) -> str:
        with self.open(url, data, headers) as response:
            return response.read().decode(response.headers.get_content_charset() or "utf-8")

    def post_json(self, url: str, value: object, referer: str | None = None) -> Any:
        """The JSON answer to a JSON body."""
        headers = {"Content-Type": "application/json; charset=UTF-8", "Accept": "application/json"} | ({"Referer": referer} if referer else {})
        return json.loads(self.text(url, json.dumps(value, ensure_ascii=False).encode(), headers))

    def submit(self, url: str, fields: dict[str, str], referer: str | None = None) -> None:
        """Sends a form in parts, such as a poll before a download, and reads its answer away."""
        body, headers = multipart(fields, uuid.uuid4().hex)
        with self.open(url, body, headers | ({"Referer": referer} if referer else {})) as response:
            response.read()

    def download(self, url: str, target: str | Path | BinaryIO, data: bytes | None = None, headers: dict[str, str] | None = None) -> dict:
        """Writes a response to a file or an open stream piece by piece and forces it to the disk: its facts and announced name."""
        digest, size = hashlib.sha256(), 0
        with self.open(url, data, headers) as response, (contextlib.nullcontext(target) if hasattr(target, "write") else open(target, "wb")) as out:
            while piece := response.read(PIECE):
                digest.update(piece)
                size += len(piece)
                out.write(piece)
            out.flush()
            with contextlib.suppress(OSError, ValueError):  # a stream that is no file
                os.fsync(out.fileno())
            return {
                "http_status": response.status, "bytes": size, "sha256": digest.hexdigest(),
                "content_type": response.headers.get("Content-Type", ""), "disposition": response.headers.get("Content-Disposition"),
            }


def download_xml(url: str, folder: str | Path, attempts: int = 3, pause: float = 0.5, timeout: float = 180.0) -> dict:
    """One XML response streamed to a file of its own in ``folder``: its facts and ``path``, or ``error`` after at most ``attempts`` tries.

    Neither the download nor the check that it is well-formed holds the document; a file that is not is
    removed before the next try.
    """
    session = Session(1, pause, timeout)
    out: dict = {"http_status": None, "bytes": None, "sha256": None, "path": None, "error": None}
    for attempt in range(1, attempts + 1):
        path, failed = Path(folder) / f"{uuid.uuid4().hex}.part", None
        try:
            out |= session.download(url, path) | {"attempts": attempt, "error": None}
            with open(path, "rb") as f:
                expat.ParserCreate().ParseFile(f)
            return out | {"path": str(path)}
        except expat.ExpatError:
            out["error"] = "not well-formed"
        except urllib.error.HTTPError as e:
            failed = e
            out |= {"http_status": e.code, "error": f"status {e.code}"}
        except OSError as e:
            out["error"] = type(e).__name__
        path.unlink(missing_ok=True)
        if attempt == attempts or (failed is not None and failed.code not in PASSING):
            return out | {"attempts": attempt}
        time.sleep(wait_of(failed, pause, attempt))
    raise AssertionError


def fetch(url: str, attempts: int = 3, pause: float = 0.5, timeout: float = 180.0, data: bytes | None = None, headers: dict[str, str] | None = None) -> dict:
    """One response with its facts, after at most ``attempts`` tries. A body that its own charset cannot decode is an error, not mended."""
    out: dict = {"http_status": None, "bytes": None, "sha256": None, "payload": None, "error": None}
    for attempt in range(1, attempts + 1):
        failed = None
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data, headers or {}), timeout=timeout) as response:
                body = response.read()
                out |= {"http_status": response.status, "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest(), "payload": None, "error": None}
                try:
                    text = out["payload"] = body.decode(response.headers.get_content_charset() or "utf-8")
                    if text.lstrip()[:1] != "<" or well_formed(text):
                        return out | {"attempts": attempt}
                    out["error"] = "not well-formed"
                except (UnicodeDecodeError, LookupError):
                    out["error"] = "not decodable"
        except urllib.error.HTTPError as e:
            failed = e
            out |= {"http_status": e.code, "error": f"status {e.code}"}
            if e.code not in PASSING:
                return out | {"attempts": attempt}
        except OSError as e:
            out["error"] = type(e).__name__
        if attempt < attempts:
            time.sleep(wait_of(failed, pause, attempt))
    return out | {"attempts": attempts}


def form(fields: dict[str, str]) -> tuple[bytes, dict[str, str]]:
    """The body and headers of a form."""
    return urllib.parse.urlencode(fields).encode(), {"Content-Type": "application/x-www-form-urlencoded; charset=UTF-8"}


def multipart(fields: dict[str, str], boundary: str) -> tuple[bytes, dict[str, str]]:
    """The body and headers of a form in parts."""
    parts = [f'--{boundary}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n' for k, v in fields.items()]
    return ("".join(parts) + f"--{boundary}--\r\n").encode(), {"Content-Type": f"multipart/form-data; boundary={boundary}"}


class _Requests(InputPartition):
    def __init__(self, requests: list[list[str]]) -> None:
        self.requests = requests


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[_Requests]:
        requests = json.loads(self.options["requests"])
        width = max(1, int(self.options.get("concurrency", "2")))
        return [_Requests(requests[n::width]) for n in range(min(width, len(requests)))]

    def read(self, partition: _Requests) -> Iterator[tuple]:
        for task_id, url in partition.requests:
            r = fetch(url, int(self.options.get("attempts", "3")), float(self.options.get("pause", "0.5")), float(self.options.get("timeout", "180")))
            shown = url.split("?")[0]  # the query may hold a key
            yield task_id, shown, r["http_status"], r["bytes"], r["sha256"], r["attempts"], r["payload"], r["error"]


class ApiSource(DataSource):
    """Options: ``requests`` (JSON list of [task_id, url]), ``concurrency``, ``attempts``, ``pause``, ``timeout``."""

    @classmethod
    def name(cls) -> str:
        return "api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def responses(spark: SparkSession, requests: list[tuple[str, str]], **options: object) -> DataFrame:
    """The responses of a planned list of requests."""
    spark.dataSource.register(ApiSource)
    return spark.read.format("api").options(requests=json.dumps(requests), **{k: str(v) for k, v in options.items()}).load()


def planned_responses(requests: DataFrame, concurrency: int = 2, **options: float) -> DataFrame:
    """The responses of ``requests`` (``task_id``, ``url``) of any number: the plan stays distributed, ``concurrency`` partitions bound the requests in flight."""
    fields = [("task_id", pa.string()), ("url", pa.string()), ("http_status", pa.int32()), ("bytes", pa.int64()), ("sha256", pa.string()), ("attempts", pa.int32()), ("payload", pa.string()), ("error", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task_id, url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_pylist([{"task_id": task_id, "url": url.split("?")[0]} | {k: v for k, v in fetch(url, **options).items()}], pa.schema(fields))

    return requests.select("task_id", "url").repartition(concurrency).mapInArrow(run, SCHEMA)
