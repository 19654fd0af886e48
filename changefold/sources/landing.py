"""The landing zone, one folder per origin table, and the quarantine beside it."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefold.functions.decode import BRONZE_SCHEMA, decode_messages, with_delivery_id
from changefold.session import write_unsorted
from changefold.sources.tables import NO_AGE
from changefold.sources.topic import MESSAGE_SCHEMA

LINES, ONE_PER_FILE = "lines", "one_per_file"
ROUTE_COLUMNS = ["src_catalog", "src_schema", "src_table"]
LANDED, QUARANTINED = "landed", "quarantined"
OFFSET_IN_NAME = r"offset_(\d+)\.json$"  # fixed value: how a landing file names its message
#: Names of a file of a listing, which is what a stream's driver knows of them.
LISTED = 2_000
#: Names that Spark's readers pass over.
HIDDEN = re.compile(r"\.|_(?!.*=)|.*\._COPYING_$", re.S)
#: Characters of documents that a task hands over at once.
AT_ONCE = 1 << 22
JSON_TOKEN = re.compile(r"""\"[^"\\]*(?:\\.[^"\\]*)*"|'[^'\\]*(?:\\.[^'\\]*)*'|[{}\[\],:]|[^\s{}\[\],:"']+""", re.S)
TEXTS = ("schema", "payload", "topic")


def route_messages(messages: DataFrame) -> DataFrame:
    """Every message with its destination: `status` and, for landed ones, the origin columns."""
    decoded = decode_messages(messages)
    good = F.col("reason").isNull()
    return with_delivery_id(decoded).select(
        "delivery_id",
        "topic",
        "partition",
        "offset",
        *[F.when(good, F.col(c)).alias(c) for c in ("schema", "payload")],
        F.when(~good, F.col("value")).alias("value"),
        "reason",
        F.when(good, LANDED).otherwise(QUARANTINED).alias("status"),
        *[F.when(good, F.col(c)).alias(c) for c in ROUTE_COLUMNS],
    )


def write_landing(messages: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append each message below `path/status=…/src_catalog=…/src_schema=…/src_table=…`, one per line.

    Good and broken messages leave in one pass over the topic; the sink's log commits a batch whole,
    so progress moves only after its files are written. No task sorts its messages by where they go.
    """
    write_unsorted(messages.sparkSession)
    writer = (
        route_messages(messages)
        .writeStream.partitionBy("status", *ROUTE_COLUMNS)
        .format("json")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def read_landing(
    spark: SparkSession,
    path: str,
    layout: str,
    route: tuple[str, str, str] | None = None,
    listing: str | None = None,
    **options: object,
) -> DataFrame:
    """Stream new landing files as bronze rows.

    `layout` says how the files look and has no default, as each wrong choice loses rows silently:
    `lines` has one object per line, `one_per_file` one indented object per file with the offset in
    its name or, as `write_one_per_file` has it, with the whole delivery inside. `route` picks one origin table from a folder that `write_landing` fills. Reading that
    folder from its root keeps to the files its log has committed, so remains of lost tasks stay out.

    No file is too old to be read, however late it arrives: Spark would pass over files seven days older than the newest.
    Each run lists the landing zone; where that grows long, let `cleanSource="archive"` move away what has been read.

    Spark's driver holds every file of the landing zone. For one message per file, `listing` is a folder of this reader's own, kept
    as long as its checkpoint, in which tasks write down the names of files that are new at this call; the stream reads the files that it
    names, so the driver holds one entry for `LISTED` of them, and `maxFilesPerTrigger`, the one option that then applies, counts
    those. It takes a landing zone on a disk that all tasks share; any other is listed by Spark.
    """
    if layout not in (LINES, ONE_PER_FILE):
        raise ValueError(f"layout is {LINES!r} or {ONE_PER_FILE!r}, not {layout!r}")
    if listing:
        if layout != ONE_PER_FILE or route or options.keys() - {"maxFilesPerTrigger"}:
            raise ValueError(f"a listing is for {ONE_PER_FILE!r} without a route, and takes no option but maxFilesPerTrigger")
        if os.path.isdir(_local(path)):
            list_files(spark, path, listing)
            return _listed_rows(spark, path, listing, options)
    schema = BRONZE_SCHEMA
    if route:
        schema += "".join(f", {c} string" for c in ("status", *ROUTE_COLUMNS))
    options = {"maxFileAge": NO_AGE, **options}
    reader = spark.readStream.schema(schema).option("multiLine", layout == ONE_PER_FILE).options(**options)
    rows = reader.json(path)
    if route:
        rows = rows.where(F.col("status") == LANDED)
        for column, name in zip(ROUTE_COLUMNS, route):
            rows = rows.where(F.col(column) == name)
    offset = F.coalesce("offset", _offset_in("_metadata.file_name"))
    return rows.select("schema", "payload", "topic", "partition", offset.alias("offset"))


def _offset_in(name: str) -> Column:
    found = F.regexp_extract(name, OFFSET_IN_NAME, 1)
    return F.when(found != "", found).cast("bigint")


def list_files(spark: SparkSession, path: str, listing: str) -> None:
    """Add to a listing the files of a landing zone that it does not have. Each has one reader, as a checkpoint has."""
    spark.createDataFrame([], "name string").write.mode("ignore").parquet(listing)
    known = spark.read.schema("name string").parquet(listing)
    found = spark.createDataFrame([(_local(path),)], "folder string").mapInArrow(_file_names, "name string")
    new = found.join(known.hint("merge"), "name", "left_anti")  # names are many, however well they compress
    if not new.isEmpty():  # or Spark writes a file without names
        new.write.mode("append").option("maxRecordsPerFile", LISTED).parquet(listing)


def _file_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the files that Spark's readers would see in a folder, below it where they lie in folders of a partitioned table."""
    for folder in (folder for batch in batches for folder in batch.column(0).to_pylist()):
        names, within = [], [""]
        while within:
            inside = within.pop()
            with os.scandir(f"{folder}/{inside}") as entries:
                for entry in entries:
                    if HIDDEN.match(entry.name):
                        continue
                    if entry.is_file():
                        names.append(inside + entry.name)
                    elif "=" in entry.name:
                        within.append(f"{inside}{entry.name}/")
                    if len(names) == LISTED:
                        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})
                        names = []
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})


def _listed_rows(spark: SparkSession, path: str, listing: str, options: dict[str, object]) -> DataFrame:
    """Stream the documents of listed files as bronze rows, as Spark's reader of whole files gives them: members as they are written."""
    names = spark.readStream.schema("name string").options(**{"maxFileAge": NO_AGE, **options}).parquet(listing)
    written = f"struct<{', '.join(f'{c} string' for c in TEXTS)}>"
    files = names.mapInArrow(_file_reader(_local(path)), f"name string, document string, written array<{written}>")
    parsed = F.posexplode_outer(F.from_json("document", f"array<struct<{BRONZE_SCHEMA}>>")).alias("i", "row")
    rows = files.select("name", "written", parsed)
    texts = [F.when(F.col(f"row.{c}").isNotNull(), F.coalesce(F.get("written", "i")[c], f"row.{c}")).alias(c) for c in TEXTS]
    return rows.select(*texts, "row.partition", F.coalesce("row.offset", _offset_in("name")).alias("offset"))


def _file_reader(folder: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Read named files: name, document, and the members that are texts, of each object at its root, as they are written."""
    text = pa.string()
    schema = pa.schema([("name", text), ("document", text), ("written", pa.list_(pa.struct([(c, text) for c in TEXTS])))])

    def read(batches):
        for batch in batches:
            rows, size = [], 0
            for name in batch.column(0).to_pylist():
                with open(f"{folder}/{name}", "rb") as file:
                    document = _text(file.read())
                if re.match(r"[ \t\r\n]*(\[[ \t\r\n]*\]|\Z)", document):
                    continue  # no rows
                written = _written(document)
                rows.append({"name": name, "document": "null" if written is None else document, "written": written})
                size += len(document)
                if size >= AT_ONCE:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def _text(content: bytes) -> str:
    """The text of UTF-8. Bytes that are none end it, and a parser that gets there finds a wrong character."""
    try:
        return content.decode("utf-8-sig")
    except UnicodeDecodeError as error:
        return error.object[: error.start].decode("utf-8-sig") + "?"


def _written(document: str) -> list[dict[str, str]] | None:
    """Members of each object at a document's root, or in an array there, as they are written; strings and nulls, which are not taken
    as they are written, are left out. Whether it is JSON is for Spark's parser to say, but for an array with a null: files of one are
    bad."""
    found, depth, root, key, start, last = [], 0, 1, None, None, None
    for token in JSON_TOKEN.finditer(document):
        first = document[token.start()]
        if first in "}],":
            if depth == root and start is not None:
                if key in TEXTS and document[start] not in "\"'" and (value := document[start : last.end()]) != "null":
                    found[-1][key] = value
                elif key in TEXTS:
                    found[-1].pop(key, None)  # the last one of a name counts
                key = start = None
            depth -= first != ","
            if not depth:
                break
        elif first == ":" and depth == root:
            key = _unescaped(last.group())
        else:
            if depth == root and key is not None and start is None:
                start = token.start()
            if depth == 1 < root and token.group() == "null":
                return None
            if first in "{[":
                root = 2 if first == "[" and not depth else root
                depth += 1
                if depth == root:
                    found.append({})
        last = token
    return found


def _unescaped(name: str) -> str:
    try:
        return json.loads(name) if "\\" in name else name[1:-1]
    except ValueError:
        return name


def write_one_per_file(routed: DataFrame, path: str) -> None:
    """Each message as one indented document in a file of its own: its members and its delivery. A message that is delivered again
    is written once. This is for other readers of such files; Spark's own are better off with lines.

    Hadoop's local file system starts four processes for a file it makes, so on a disk that all tasks share they write their
    files themselves, named by the delivery: a task that runs again makes the same files. Elsewhere Spark's text sink does it.
    """
    members = [F.expr(f"try_parse_json({c})").alias(c) for c in ("schema", "payload")]
    delivery = ["topic", "partition", "offset"]
    document = F.to_json(F.struct(*members, *delivery), {"pretty": "true"}).alias("value")
    name = F.concat(F.sha2(F.to_json(F.struct(*delivery)), 256), F.lit(".txt")).alias("name")
    files = routed.dropDuplicates(delivery).select(name, document)

    files.limit(0).write.partitionBy("name").text(path)  # makes the folder, which has to be a new one
    folder = _local(path)
    if os.path.exists(f"{folder}/_SUCCESS"):
        files.mapInArrow(_file_writer(folder), "files bigint").write.format("noop").mode("overwrite").save()
    else:
        files.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)


def _local(path: str) -> str:
    """Where a path would lie on the local disk."""
    parts = urlsplit(path)
    return os.path.abspath(unquote(parts.path) if parts.scheme == "file" else path)


def _file_writer(folder: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write (name, text) rows as files, each whole as soon as it has its name; readers pass over those with a dot."""

    def write(batches):
        for batch in batches:
            for name, text in zip(*(column.to_pylist() for column in batch.columns)):
                started = f"{folder}/.{uuid.uuid4().hex}"
                with open(started, "w", encoding="utf-8", newline="") as file:
                    file.write(f"{text}\n")
                os.replace(started, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    return write


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The messages that `write_landing` set aside, with the reason."""
    rows = spark.read.schema(f"delivery_id string, {MESSAGE_SCHEMA}, reason string, status string").json(path)
    return rows.where(F.col("status") == QUARANTINED).drop("status")
