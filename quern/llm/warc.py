"""WARC archives and their index, merged from sorted runs.

``write_archives`` writes captures as WARC 1.1 records with Spark's own text writer (a record ends in two
line ends, which is the writer's separator), so that every Hadoop file system, its commit protocol and task
retries just work. A capture whose payload equals that of another is written as a ``revisit`` that refers to
it. Which payloads repeat is found from digests alone; only digests that occur twice are joined back, and the
table of those is written first, so that the optimizer knows its size.

``read_archives`` parses whole archives by their content lengths and gives one index row per record. The rows
of an archive are a run sorted by URL key and timestamp. ``merge_index`` deals all runs out by ranges of
(URL key, timestamp, record), so that a URL with a third of all captures is spread over many ranges, and
merges the runs of a range in a loser tree. Ranges follow each other: the result is in global order.

Defined results:
- A null payload is empty. Payloads under ``least`` bytes are always responses. Of equal payloads all rows
  with the smallest id are responses; if an id repeats, so does the response. Null ids are revisits unless all
  ids of the payload are null.
- A null URL is an empty one, a null timestamp an empty date, which sorts first. Line ends in a URL are
  percent-encoded.
- An empty table gives no archive and an empty index. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import map_columns, shared_folder, whole, written

# Fixed values of the format (WARC 1.1).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

CLASSES = (4096, 128, 4)  # records to an archive, by class of length; longer ones have archives of their own

INDEX = (
    "url_key string, timestamp string, record bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, digest_matches boolean, archive string, offset bigint, length bigint"
)


def url_key(url: str) -> str:
    """The host's labels in reverse, then the path: captures of one site sort together."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.strip().lower())
    host, slash, path = re.match(r"([^/?#]*)(/?)(.*)", rest, re.DOTALL).groups()
    host = re.sub(r"^[^@]*@|:\d*$", "", host)
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + ")/" + path.split("#")[0]


def _records(captures: DataFrame) -> Column:
    """The text of a record without its final line ends."""

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("id"))
    block = F.when(revisit, F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8" + END)).otherwise(
        F.concat(http, F.col("payload"))
    )
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(VERSION),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))),
        header("WARC-Date", F.col("date")),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        header("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                header("WARC-Profile", F.lit(PROFILE)),
                header("WARC-Refers-To", F.concat(F.lit("<urn:capture:"), F.col("refers_to").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def write_archives(
    captures: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    timestamp: Column | None = None,
    least: int = 100,
    records_per_archive: int = 4000,
    archive_bytes: int = 64 << 20,
) -> None:
    """Write one record per row into archives of at most ``records_per_archive`` records below ``path``.

    Payloads in an archive come to at most ``archive_bytes``, or it holds a single record: records are written by
    classes of length, each with as many records to an archive as its longest ones allow.
    """
    when = F.lit(None) if timestamp is None else F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = captures.select(
        F.col(key).cast("bigint").alias("id"),
        whole(url).alias("url"),
        F.coalesce(when, F.lit("")).alias("date"),
        whole(payload).alias("payload"),
    )
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256)
    )
    longest = [archive_bytes // n for n in CLASSES]
    number = sum((F.col("bytes") > most).cast("int") for most in longest)
    # Repeated digests and, counted in the same pass, the classes that occur; a class is no digest's text.
    found = written(
        rows.select("id", F.explode(F.array(F.when(F.col("bytes") >= least, F.col("digest")), number.cast("string"))).alias("of"))
        .where("of is not null")
        .groupBy("of")
        .agg(F.count("*").alias("rows"), F.min("id").alias("refers_to"))
        .where("rows > 1 or length(of) = 1")
        .select("of", "refers_to"),
        "warc-repeated",
    )
    repeated = found.where("length(of) > 1")
    classes = {int(r["of"]) for r in found.where("length(of) = 1").collect()}  # four at most
    told = rows.join(repeated, (F.col("digest") == F.col("of")) & (F.col("bytes") >= least), "left")
    for i, records in enumerate([*CLASSES, 1]):
        if i in classes or i == 0:
            told.where(number == i).select(_records(told).alias("value")).write.mode("append").option("lineSep", END).option(
                "maxRecordsPerFile", min(records, records_per_archive)
            ).text(path)


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], int, int, int]]:
    """Headers, start, start of the block and end of every record; the record's final line ends not counted."""
    at = 0
    while at < len(content):
        block = content.index(b"\r\n\r\n", at) + 4
        lines = content[at:block].decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:] if line)
        end = block + int(headers["Content-Length"])
        yield headers, at, block, end
        at = end + len(END)


def _capture(headers: dict[str, str], field: str) -> int | None:
    found = headers.get(field, "").removeprefix("<urn:capture:").removesuffix(">")
    return int(found) if found and found != "none" else None


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("path string, modificationTime timestamp, length bigint, content binary")
        .format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "content")
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index row per record; the rows of an archive are a run in the order of URL key, timestamp, record.

    Payload length and digest are those of the payload read; a revisit has none and states them in its
    header. ``digest_matches`` tells whether the payload read has the stated digest (true for revisits).
    """

    def run(batches: Iterator[list]) -> Iterator[list]:
        for paths, contents in batches:
            for archive, content in zip(paths.to_pylist(), contents, strict=True):
                body, rows = content.as_py(), []
                for headers, start, block, end in _parse(body):
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    length, digest = int(headers["X-Payload-Length"]), stated
                    if headers["WARC-Type"] == "response":
                        payload = memoryview(body)[body.index(b"\r\n\r\n", block) + 4 : end]
                        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    url = headers["WARC-Target-URI"]
                    rows.append(
                        (
                            url_key(url),
                            headers["WARC-Date"],
                            _capture(headers, "WARC-Record-ID"),
                            url,
                            headers["WARC-Type"],
                            _capture(headers, "WARC-Refers-To"),
                            length,
                            digest,
                            digest == stated,
                            archive,
                            start,
                            end - start,
                        )
                    )
                rows.sort(key=_order)
                if rows:
                    yield list(zip(*rows, strict=True))

    return map_columns(_contents(spark, path), run, INDEX)


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """record, payload (string): the payload of every record; of a revisit, that of the response it refers to."""

    def run(batches: Iterator[list]) -> Iterator[list]:
        for _, contents in batches:
            for content in contents:
                body = content.as_py()
                rows = [
                    (
                        _capture(headers, "WARC-Record-ID"),
                        _capture(headers, "WARC-Refers-To"),
                        body[body.index(b"\r\n\r\n", block) + 4 : end].decode(),
                    )
                    for headers, _, block, end in _parse(body)
                ]
                if rows:
                    yield list(zip(*rows, strict=True))

    found = map_columns(_contents(spark, path), run, "record bigint, refers_to bigint, payload string")
    own = found.where("refers_to is null")
    referred = own.select(F.col("record").alias("response"), F.col("payload").alias("full")).dropDuplicates(["response"])
    revisits = found.where("refers_to is not null").join(referred, F.col("refers_to") == F.col("response"))
    return own.select("record", "payload").union(revisits.select("record", "full"))


def _order(row: tuple) -> tuple:
    """URL key, timestamp, record; records without an id first."""
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merges k sorted runs with one comparison per level for each row taken."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = len(runs)
        self.heads: list[tuple | None] = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int) -> tuple | None:
        row = next(self.runs[i], None)
        return None if row is None else (_order(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; -1 stands for a place not yet played, which wins."""
        if a == -1 or b == -1:
            return a == -1
        one, other = self.heads[a], self.heads[b]
        return one is not None and (other is None or one[:2] < other[:2])

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node > 0:
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[self.losers[0]]) is not None:
            yield head[2]
            self.heads[head[1]] = self._next(head[1])
            self._play(head[1])


def merge_index(index: DataFrame, batch: int = 4096, range_rows: int = 200_000) -> DataFrame:
    """The index in global order of (url_key, timestamp, record), with ``position`` ascending in that order.

    Spark brings the pieces of a run together in a range; their rows then stream through the tree. A task holds its
    range's rows, about ``range_rows`` at most: there are as many ranges as the index asks for, and no fewer than the
    session's shuffle partitions.
    """
    names = index.columns
    ranges = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-index.count() // range_rows))
    dealt = (
        index.repartitionByRange(ranges, F.col("url_key"), F.col("timestamp"), F.col("record"))
        .sortWithinPartitions("archive", "url_key", "timestamp", "record")
        .withColumn("range", F.spark_partition_id())
    )

    def run(batches: Iterator[list]) -> Iterator[list]:
        runs: dict[str, list[tuple]] = {}
        number = 0
        for columns in batches:
            for *row, number in zip(*(c.to_pylist() for c in columns), strict=True):
                runs.setdefault(row[9], []).append(tuple(row))
        rows: list[tuple] = []
        for at, row in enumerate(LoserTree([iter(r) for r in runs.values()])):
            rows.append((*row, (number << 33) + at))
            if len(rows) == batch:
                yield list(zip(*rows, strict=True))
                rows = []
        if rows:
            yield list(zip(*rows, strict=True))

    return map_columns(dealt.select(*names, "range"), run, f"{INDEX}, position bigint")


def archived(spark: SparkSession, captures: DataFrame, **options) -> DataFrame:
    """Write ``captures`` into archives in the shared folder, read them back and give the merged index.

    The sorted runs are stored, so that dealing them out by ranges, which samples, reads no archive again.
    """
    path = shared_folder(spark, "warc")
    write_archives(captures, path, **options)
    return merge_index(written(read_archives(spark, path), "warc-runs"))
