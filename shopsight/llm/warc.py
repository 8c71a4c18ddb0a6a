"""WARC archives of pages, written and read by Spark tasks through an index.

Each record is a gzip member of its own in a ``.warc.gz`` file. Of pages with equal
payloads of at least ``revisit_from`` bytes the one with the largest page_id is written as
``response``; the others become ``revisit`` records that name it and hold no payload.
Writing yields the index: file, offset and length of each record, its URL and its payload
digest. Reading starts from index rows, whichever are selected: they are
sorted by file and offset, neighbouring byte ranges are read at once, and each record is unpacked from
its own bytes. Digests of payloads that were read are checked against the record.

Two fields besides the standard's carry the integer ids: ``X-Page-ID`` and
``X-Refers-To-Page-ID``. A file is written under a passing name and renamed; a task that is
run again leaves the same file.

Defined results: null html is an empty payload; a null url is the empty URL; null
page_ids revisit the largest id of their payload and are responses where there is none;
rows that repeat the largest page_id are responses too; an empty table has no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.files import filesystem, write_once
from shopsight.llm.tables import map_batches, save, shared_path

#: Ranges with a gap of at most ``GAP`` bytes are read at once, up to ``READ`` bytes.
GAP, READ = 1 << 16, 8 << 20
#: Bytes of a file that one task reads.
STRETCH = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, file string, offset long, length long, url string, digest string, record_type string"
RECORD = "page_id long, record_type string, url string, payload binary, payload_bytes long, digest string, refers_to long"


def digest(payload: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{payload_digest}')}>"


def _member(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """One record as a gzip member, and the payload's digest."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, own)),
        ("WARC-Date", date),
        # a line break would end the field
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, own)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush(), own


def _parse(member: bytes) -> dict:
    """A record's columns; raises ValueError if it is damaged."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "record_type": kind,
        "url": fields["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "digest": stated,
        "refers_to": number("X-Refers-To-Page-ID"),
    }


def _with_referred(pages: DataFrame, revisit_from: int) -> DataFrame:
    """(page_id, url, html, refers_to): the page whose equal payload is stored, null for stored ones."""
    html = F.coalesce("html", F.lit(""))
    known = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("_sha")
    )
    # ids and digests alone decide who refers to whom; payloads meet the answer by page_id, which is not skewed
    small = save(known.select("page_id", "_sha", F.octet_length("html").alias("_size")), "payload-digests")
    stored = small.groupBy("_sha").agg(F.max("page_id").alias("_stored"))
    refers = F.when((F.col("_size") >= revisit_from) & ~F.col("page_id").eqNullSafe(F.col("_stored")), F.col("_stored"))
    answers = small.join(stored, "_sha").select(
        F.col("page_id").alias("_id"), F.col("_sha").alias("_digest"), refers.alias("refers_to")
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest"))
    return known.join(answers.distinct(), same).select("page_id", "url", "html", "refers_to")


def write(pages: DataFrame, revisit_from: int = 0, folder: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write (page_id, url, html) to archives and return the index, a row for each record.

    ``folder`` defaults to a new one in the shared folder.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz"
        index: dict[str, list] = {c.split()[0]: [] for c in INDEX.split(", ")}

        def members() -> Iterator[bytes]:
            offset = 0
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, url, html, refers_to = (batch.column(c)[i].as_py() for c in ("page_id", "url", "html", "refers_to"))
                    member, own = _member(page_id, url, html.encode(), refers_to, date)
                    kind = "response" if refers_to is None else "revisit"
                    for name, value in zip(index, (page_id, file, offset, len(member), url, own, kind), strict=True):
                        index[name].append(value)
                    offset += len(member)
                    yield member

        first = next(rest := members(), None)
        if first is not None:
            write_once(file, _chain(first, rest))
            kinds = {"long": pa.int64(), "string": pa.string()}
            schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in INDEX.split(", ")])
            yield pa.RecordBatch.from_pydict(index, schema)

    ordered = _with_referred(pages, revisit_from).sortWithinPartitions("page_id", "url", "html")
    return save(map_batches(ordered, run, INDEX), "warc-index")


def _chain(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def coalesced(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(begin, end, ranges) of reads that cover ascending (offset, length) ranges."""
    some: list[tuple[int, int]] = []
    begin = end = 0
    for offset, length in ranges:
        if some and (offset - end > GAP or offset + length - begin > READ):
            yield begin, end, some
            some = []
        if not some:
            begin = end = offset
        some.append((offset, length))
        end = max(end, offset + length)
    if some:
        yield begin, end, some


def read(index: DataFrame) -> DataFrame:
    """The records (page_id, record_type, url, payload, payload_bytes, digest, refers_to) that the rows of ``index`` point to.

    ``payload`` is null for revisits; ``payload_bytes`` and ``digest`` are those of the full payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            for file in dict.fromkeys(files):
                ranges = [(o, n) for f, o, n in zip(files, offsets, lengths, strict=True) if f == file]
                store, path = filesystem(file)
                with store.open_input_file(path) as data:
                    for begin, end, some in coalesced(ranges):
                        part = data.read_at(end - begin, begin)
                        rows = [_parse(part[o - begin : o - begin + n]) for o, n in some]
                        yield pa.RecordBatch.from_pylist(rows, schema)

    located = index.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("stretch"))
    # a row of the index is tiny, but stands for a record: as many tasks as stretches, whatever the rows weigh
    stretches = max(1, located.select("file", "stretch").distinct().count())
    ordered = located.repartition(stretches, "file", "stretch").sortWithinPartitions("file", "offset")
    return map_batches(ordered.select("file", "offset", "length"), run, RECORD)
