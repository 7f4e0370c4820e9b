"""WARC archives: writing with payload de-duplication, and a Python data source.

Writing: equal payloads are found by their SHA-1 digest.  One of each group is
a ``response`` record, the others are ``revisit`` records that name it and
carry no payload.  Each task writes its own archives of bounded size.

Reading: the ``warc`` data source plans one partition per run of archive files,
takes filters on ``record_type`` and on header columns down into the scan,
parses headers first and steps over the payload of every record that a filter
turns away, or whenever ``payload`` is not asked for (option ``payload=false``).

Defined results: a null html is an empty payload; a null page_id sorts below
all others and is written without its header; among equal payloads the largest
page_id is the response, and rows that share that page_id are responses alike;
an empty table writes no archive and reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import posixpath
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from streamops.llm.common import filesystem, scratch_path, settle

ARCHIVE_BYTES = 64 << 20
SALT = 16
SCHEMA = ("page_id long, url string, record_type string, record_id string, refers_to string, payload_digest string, "
          "content_length long, payload_bytes long, payload binary, archive string, at long")
HEADER_COLUMNS = {"page_id", "url", "record_type", "record_id", "refers_to", "payload_digest"}
URN = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split("\n")).replace("\r", " ")


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <{URN}{page_id}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {clean(url)}")
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha}",
             "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{URN}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = http if kind == "revisit" else http + payload
    head.append(f"Content-Length: {len(body)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + body + b"\r\n\r\n"


def roles(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload_digest, record_type and refers_to to pages.

    Groups are found on digests alone, pre-aggregated; only groups of two or
    more go back to the pages, from a written table whose size Spark knows: a
    small one is broadcast, a larger one is joined on (digest, salt), so a
    payload that a third of all pages share is not one task's work."""
    raw = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(raw).alias("_sha"),
                         F.length(raw).alias("_bytes"))
    big = keyed.where(F.col("_bytes") >= min_bytes)
    groups = big.groupBy("_sha").agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    groups = settle(spark, groups.select("_sha", "_first"), "groups").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int")
    lead = F.when(F.col("_bytes") >= min_bytes, F.col("_first"))
    revisit = lead.isNotNull() & ~F.col("page_id").eqNullSafe(lead)
    return keyed.withColumn("_salt", salt).join(groups, ["_sha", "_salt"], "left").select(
        "page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, lead).alias("refers_to"))


def write(spark: SparkSession, pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives under ``path``; one row per archive (path, records).

    An attempt writes to names of its own and only a finished task reports
    them, so a lost or repeated task leaves no half archive in the list."""

    def run(batches):
        fs, top = filesystem(path)
        fs.create_dir(top, recursive=True)
        task, made, out, size, n, name = TaskContext.get(), [], None, 0, 0, ""
        for b in batches:
            for row in b.to_pylist():
                payload = (row["html"] or "").encode("utf-8")
                if out is None:
                    name = f"{task.partitionId():06d}-{task.taskAttemptId():09d}-{len(made):04d}.warc"
                    out, size, n = fs.open_output_stream(posixpath.join(top, name)), 0, 0
                data = record(row["record_type"], row["page_id"], row["url"], payload, digest(payload), row["refers_to"])
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    out.close()
                    made, out = [*made, (name, n)], None
        if out is not None:
            out.close()
            made.append((name, n))
        yield pa.RecordBatch.from_arrays([pa.array([posixpath.join(path, m[0]) for m in made], pa.string()),
                                          pa.array([m[1] for m in made], pa.int64())], ["archive", "records"])

    return roles(spark, pages, min_bytes).mapInArrow(run, "archive string, records long")


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    """Headers first: a record whose headers fail a filter is stepped over."""

    def __init__(self, options: dict):
        self.manifest, self.path = options.get("manifest"), options.get("path", "")
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.per_task = int(options.get("archivesPerTask", "1"))
        self.wanted: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and name in HEADER_COLUMNS:
                new = {f.value}
            elif isinstance(f, In) and name in HEADER_COLUMNS:
                new = set(f.value)
            elif isinstance(f, IsNotNull) and name in HEADER_COLUMNS:
                self.present.add(name)
                continue
            else:
                yield f
                continue
            self.wanted[name] = self.wanted.get(name, new) & new

    def partitions(self) -> list[InputPartition]:
        """One partition for each run of archives: those listed in the folder,
        or in the manifest (a folder of text files with one archive a line)."""
        if self.manifest:
            fs, top = filesystem(self.manifest)
            parts = [x.path for x in fs.get_file_info(pafs.FileSelector(top)) if x.base_name.startswith("part-")]
            paths = sorted(x for p in parts for x in fs.open_input_file(p).read().decode().split("\n") if x)
        else:
            fs, top = filesystem(self.path)
            found = fs.get_file_info(pafs.FileSelector(top))
            paths = sorted(posixpath.join(self.path, x.base_name) for x in found if x.base_name.endswith(".warc"))
        return [Files(paths[i:i + self.per_task]) for i in range(0, len(paths), self.per_task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            fs, p = filesystem(path)
            with fs.open_input_file(p) as raw:
                yield from self.records(io.BufferedReader(raw, 1 << 20), path)

    def records(self, f, path: str) -> Iterator[tuple]:
        while True:
            at, line = f.tell(), f.readline()
            if not line:
                return
            if line in (b"\r\n", b"\n"):
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: no WARC record at byte {at}")
            head = read_headers(f)
            length = int(head.get("content-length", 0))
            row = {"page_id": page_of(head.get("warc-record-id")), "url": head.get("warc-target-uri"),
                   "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
                   "refers_to": head.get("warc-refers-to"),
                   "payload_digest": (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None}
            end = f.tell() + length
            if all(row[k] in v for k, v in self.wanted.items()) and all(row[k] is not None for k in self.present):
                http = read_headers(f) if f.readline().startswith(b"HTTP/") else {}
                body = max(0, end - f.tell())
                stored = row["record_type"] != "revisit"
                payload = f.read(body) if (self.payload or self.verify) and stored else None
                if self.verify and stored:
                    body = len(payload)
                    if digest(payload) != row["payload_digest"]:
                        raise ValueError(f"{path}: the payload at byte {at} does not match its digest")
                payload = payload if self.payload else None
                yield (*row.values(), length, body if stored else int(http.get("content-length", 0)), payload, path, at)
            f.seek(end)


def read_headers(f) -> dict[str, str]:
    head: dict[str, str] = {}
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8").partition(":")
        head[name.strip().lower()] = value.strip(" \t\r\n")
    return head


def page_of(record_id: str | None) -> int | None:
    inner = (record_id or "").strip("<>")
    return int(inner.removeprefix(URN)) if inner.startswith(URN) else None


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))


def read(spark: SparkSession, path: str, payload: bool = True, verify: bool = False,
         manifest: str | None = None) -> DataFrame:
    """The records of the archives in a folder, or of those in a manifest.

    ``payload=False`` leaves the payload column null; ``verify=True`` checks
    every stored payload against the digest in its headers, in the task."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    r = spark.read.format("warc").option("payload", str(payload).lower()).option("verify", str(verify).lower())
    return (r.option("manifest", manifest) if manifest else r).option("path", path).load()


def write_archives(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> tuple[str, str]:
    """Write all pages; (folder, manifest of the archives of finished tasks)."""
    top = scratch_path(spark, "warc")
    folder, listed = posixpath.join(top, "archives"), posixpath.join(top, "manifest")
    write(spark, pages, folder, min_bytes).select("archive").repartition(1).write.text(listed)
    return folder, listed


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages, read every record back and check it against its digest."""
    folder, manifest = write_archives(spark, pages, min_bytes)
    back = read(spark, folder, payload=False, verify=True, manifest=manifest)
    refers = F.regexp_extract("refers_to", "page:(-?[0-9]+)", 1)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type",
                       F.when(F.col("record_type") == "revisit", refers.try_cast("long")).alias("refers_to"),
                       "archive", "at")
