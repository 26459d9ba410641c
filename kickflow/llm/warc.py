"""WARC archives: writing pages as records, and reading them back by verified boundaries."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kickflow.llm.common import bounded_batches, stored

# Fixed by the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"

_length = re.compile(rb"\r\nContent-Length: *(\d+)", re.IGNORECASE)


def write_warc(
    pages: DataFrame,
    path: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = DATE,
) -> None:
    """A record per row of ``pages``, in as many archives below ``path`` as there are partitions.

    The payload is the text in UTF-8 (null: empty). Of payloads that are equal and have at
    least 100 bytes, the row with the smallest id (nulls last) is a response, and the others
    are revisits without a payload that refer to it; rows that repeat the smallest id are
    responses, too. A null url gives no target; line ends in a url are percent-encoded. Other
    columns are not read. Payloads stay in the task that reads them, unless there are too many
    groups of equal payloads to send to every task.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(id).cast("string").alias("id"),
        F.col(id).alias("order"),
        F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("body"),
        F.octet_length(body).alias("bytes"),
        F.sha2(body, 256).alias("digest"),
    )
    least = F.min(F.struct(F.col("order").isNull().alias("none"), "order"))
    groups = rows.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
    groups = groups.agg(least.alias("least"), F.count("*").alias("n")).where("n > 1")
    groups = groups.select(
        F.col("digest").alias("same"),
        F.col("least.order").alias("first"),
        F.col("least.order").cast("string").alias("first_id"),
    )
    groups = stored(groups, "equal-payloads")
    rows = rows.join(groups, rows["digest"] == groups["same"], "left")
    revisit = F.col("same").isNotNull() & ~F.col("order").eqNullSafe(F.col("first"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda value: F.concat(F.lit("<urn:page:"), F.coalesce(value, F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(line("WARC-Refers-To", urn(F.col("first_id"))), line("WARC-Profile", F.lit(PROFILE))),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    # The separator that the writer puts after a row is what ends a record.
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def page_id(record_id: str) -> F.Column:
    """The page id in a record id that ``write_warc`` has given (null: a row without id)."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, with the file and the part of it that a task has read."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.col("value").cast("binary").alias("line"),
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """File, part, number and relative offset of each line; a part's lines come in order."""
    now, i, at = None, 0, 0
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("file", "part", "line"))
        for file, part, line in zip(*columns, strict=True):
            if (file, part) != now:
                now, i, at = (file, part), 0, 0
            yield file, part, i, at, line
            i, at = i + 1, at + len(line) + len(MAGIC)


def _header(line: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, where the block begins, and its length; None if this is no record's start."""
    end = line.find(END.encode())
    if end < 0:
        return None
    found = _length.search(b"\r\n" + line[:end])
    if not found:
        return None
    fields = {}
    for row in line[:end].decode("utf-8", "replace").split("\r\n"):
        name, _, value = row.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + len(END), int(found[1])


def _payload(block: bytes) -> bytes:
    return block.partition(END.encode())[2]


CANDIDATES = (
    "file string, part long, number long, at long, size long, next long, exit long,"
    " record_type string, record_id string, target_uri string, refers_to string,"
    " declared string, payload_bytes long, payload_digest string"
)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per magic: where a record that began there would end (``next``).

    Offsets are relative to the part's first line. ``exit`` follows successors as long as they
    are in the same part. The payload is digested if the line has all of it.
    """
    schema = ["file", "part", "number", "at", "size", "next", "exit", "record_type", "record_id"]
    schema += ["target_uri", "refers_to", "declared", "payload_bytes", "payload_digest"]

    def flush(rows: list[list]) -> pa.RecordBatch:
        exits: dict[int, int | None] = {}
        for row in reversed(rows):
            start = row[3] - len(MAGIC)
            row[6] = exits[start] = exits.get(row[5], row[5])
        kinds = [pa.string(), *[pa.int64()] * 6, *[pa.string()] * 5, pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], schema
        )

    rows: list[list] = []
    for file, part, number, at, line in _placed(batches):
        if rows and rows[-1][:2] != [file, part]:
            yield flush(rows)
            rows = []
        row = [file, part, number, at, len(line) + len(MAGIC), *[None] * 9]
        if not (part == 0 and number == 0) and (head := _header(line)):
            fields, begins, length = head
            row[5] = at + begins + length + len(END)
            row[7:12] = [
                fields.get(x)
                for x in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")
            ]
            if len(line) >= begins + length:
                data = _payload(line[begins : begins + length])
                row[12:14] = [len(data), hashlib.sha256(data).hexdigest()]
        rows.append(row)
    if rows:
        yield flush(rows)


def _reachable(found: DataFrame) -> DataFrame:
    """(file, entry): the first record of each part that a file's chain of records passes.

    Pointer jumping: ``ahead`` leads 1, 2, 4, ... parts on, so the number of rounds is the
    logarithm of the number of parts of a file.
    """
    ahead = stored(found.where("exit IS NOT NULL").select("file", "start", "exit"), "jumps")
    reached = stored(found.where("start = 0").select("file", F.col("start").alias("entry")), "reached")
    n = reached.count()
    while n:
        here = ahead.withColumnRenamed("start", "entry")
        more = reached.join(here, ["file", "entry"]).select("file", F.col("exit").alias("entry"))
        reached = stored(reached.unionAll(more).distinct(), "reached")
        before, n = n, reached.count()
        if n == before:
            break
        then = ahead.select("file", F.col("start").alias("exit"), F.col("exit").alias("further"))
        ahead = ahead.join(then, ["file", "exit"]).select("file", "start", F.col("further").alias("exit"))
        ahead = stored(ahead, "jumps")
    return reached


def _chain(key: tuple, records: pd.DataFrame) -> pd.DataFrame:
    """The records of a part that its entries lead to."""
    nexts = dict(zip(records["start"], records["next"], strict=True))
    keep = set()
    for start in records.loc[records["entered"], "start"]:
        while start in nexts and start not in keep:
            keep.add(start)
            start = nexts[start]
    return records.loc[records["start"].isin(keep), ["file", "part", "number"]]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, without their payloads (``payloads`` has them).

    Columns: ``file``, ``offset``, ``end``, ``record_type``, ``record_id``, ``target_uri``,
    ``refers_to``, ``declared`` (digest field), ``payload_bytes`` and ``payload_digest`` of the
    payload that is really there.

    Archives are split like any text, at magics, so a payload that holds a magic yields false
    candidates. Every candidate names its successor; what the chain from the start of the file
    does not reach is rejected. A file without a record at its start has none. A truncated
    last record is not returned. No archives give an empty table.
    """
    bounded_batches(spark)
    found = stored(_lines(spark, path).mapInArrow(_candidates, CANDIDATES), "candidates")
    parts = found.groupBy("file", "part").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "file", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")
    )
    found = found.join(parts, ["file", "part"])
    for name in ("next", "exit"):
        found = found.withColumn(name, F.col("base") + F.col(name))
    found = found.withColumn("start", F.col("base") + F.col("at") - len(MAGIC))
    found = stored(found.where("start >= 0"), "candidates")
    entries = _reachable(found).withColumn("entered", F.lit(True))
    chains = found.where("next IS NOT NULL").join(
        entries.withColumnRenamed("entry", "start"), ["file", "start"], "left"
    )
    chains = chains.select("file", "part", "number", "start", "next", F.coalesce("entered", F.lit(False)).alias("entered"))
    kept = chains.groupBy("file", "part").applyInPandas(_chain, "file string, part long, number long")
    # The last line of a file has no magic after it.
    sizes = found.groupBy("file").agg((F.max(F.col("start") + F.col("size"))).alias("file_bytes"))
    records = found.join(kept, ["file", "part", "number"]).join(sizes, "file").where("next <= file_bytes")
    records = stored(records, "records")
    split = records.where("payload_digest IS NULL")
    if not split.isEmpty():
        whole = _bodies(spark, path, found, split).select(
            "file",
            "start",
            F.octet_length("payload").cast("long").alias("b"),
            F.sha2("payload", 256).alias("d"),
        )
        records = records.join(whole, ["file", "start"], "left")
        records = records.withColumn("payload_bytes", F.coalesce("payload_bytes", "b"))
        records = records.withColumn("payload_digest", F.coalesce("payload_digest", "d"))
    return records.select(
        "file",
        F.col("start").alias("offset"),
        F.col("next").alias("end"),
        "record_type",
        "record_id",
        "target_uri",
        "refers_to",
        "declared",
        "payload_bytes",
        "payload_digest",
    )


def with_full_payloads(records: DataFrame) -> DataFrame:
    """``records`` of ``read_warc``, where a revisit has the size and digest of its response's payload.

    A revisit finds it by the digest that it declares, of which there is one payload however
    many responses repeat it or share an id, or have none: each record stays one row. A revisit
    whose payload is in none of the archives keeps its own values.
    """
    whole = records.where("record_type = 'response'").groupBy("payload_digest")
    whole = whole.agg(F.first("payload_bytes").alias("full_bytes")).withColumnRenamed("payload_digest", "full_digest")
    revisits = records.where("record_type = 'revisit'")
    found = revisits.join(whole, F.concat(F.lit("sha256:"), whole["full_digest"]) == revisits["declared"], "left")
    found = found.withColumn("payload_bytes", F.coalesce("full_bytes", "payload_bytes"))
    found = found.withColumn("payload_digest", F.coalesce("full_digest", "payload_digest"))
    rest = records.where("record_type <> 'revisit' OR record_type IS NULL")
    return rest.unionByName(found.select(*records.columns))


def _bodies(spark: SparkSession, path: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """(file, start, payload) of ``records``, put together from all lines they span."""
    # The owner of a rejected candidate is the last record that begins before it.
    of = records.select("file", "start", F.col("next").alias("end")).withColumn("own", F.col("start"))
    lines = found.select("file", "part", "number", "start").join(of, ["file", "start"], "left")
    last = Window.partitionBy("file").orderBy("start")
    lines = lines.withColumn("owner", F.last("own", True).over(last))
    lines = lines.withColumn("end", F.last("end", True).over(last)).where("start < end")
    lines = stored(lines.select("file", "part", "number", "start", "owner", "end"), "lines")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _placed(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[0]]), *(pa.array([x], pa.int64()) for x in row[1:3]), pa.array([row[4]], pa.binary())],
                ["file", "part", "number", "line"],
            )

    raw = _lines(spark, path).mapInArrow(numbered, "file string, part long, number long, line binary")
    pieces = F.array_sort(F.collect_list(F.struct("start", "line")))
    joined = raw.join(lines, ["file", "part", "number"]).groupBy("file", "owner", "end").agg(pieces.alias("p"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pieces in batch.column("p").to_pylist():
                whole = MAGIC.encode().join(x["line"] for x in pieces)
                _, begins, length = _header(whole)
                out.append(_payload(whole[begins : begins + length]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("owner"), pa.array(out, pa.binary())],
                ["file", "start", "payload"],
            )

    return joined.mapInArrow(cut, "file string, start long, payload binary")


def payloads(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """(file, offset, payload) of the given records of ``read_warc``, from a second reading."""
    bounded_batches(spark)
    found = stored(_lines(spark, path).mapInArrow(_candidates, CANDIDATES), "candidates")
    parts = found.groupBy("file", "part").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("file", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    found = found.join(parts, ["file", "part"])
    found = found.withColumn("start", F.col("base") + F.col("at") - len(MAGIC)).where("start >= 0")
    records = records.select("file", F.col("offset").alias("start"), F.col("end").alias("next"))
    return _bodies(spark, path, found, records).withColumnRenamed("start", "offset")
