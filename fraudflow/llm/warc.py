"""WARC archives of Zstandard frames: writer and reader (dealt operator 6).

An archive is a skippable frame (magic 0x184D2A5D) that holds the dictionary,
then one frame a record.  Archives are rows (archive, content): a table that
the writer makes, or files read by Spark's ``binaryFile`` source.
"""

from __future__ import annotations

import base64
import hashlib
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
RECORDS = ("archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary, error string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_originals(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", text_col: str = "html") -> DataFrame:
    """``pages`` with refers_to: the smallest id of rows with an equal payload, null for that row itself.

    Payloads under ``min_bytes`` and rows with a null id refer to none.  Only
    ids and digests are grouped; a payload that a third of all rows share is
    one partial row a task, and its rows are joined back by id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("html"))
    keys = rows.where(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)).select("page_id", F.sha2("html", 256).alias("digest"))
    groups = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("last > first")
    later = (keys.join(stored(groups.select("digest", "first"), "payload-groups"), "digest").where("page_id > first")
             .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to")).distinct())
    # ids may repeat with other payloads, so the digest is joined too
    return (rows.withColumn("digest", F.sha2("html", 256)).join(later, (F.col("page_id") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
            .select("page_id", "html", "refers_to"))


def record(kind: str, record_id: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit names the payload's digest and length but doesn't hold it."""
    held = b"" if kind == "revisit" else payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Target-URI", uri),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
            ("X-Payload-Length", str(len(payload)))]
    if refers_to:
        head += [("WARC-Refers-To", f"<{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(held)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + held + b"\r\n\r\n"


def write_archives(pages: DataFrame, archive_bytes: int = 16 << 20, level: int = 3, dictionary_bytes: int = 16 << 10,
                   sample_bytes: int = 512 << 10) -> DataFrame:
    """archive, content: the archives of rows (page_id, html, refers_to).

    A task starts a new archive after ``archive_bytes`` of payload.  The
    dictionary is trained on an archive's first ``sample_bytes``, a bound that
    only concerns compression; fewer than 16 records are cut into pieces for
    it.  Records too small or too alike to train on give an archive without one.
    """
    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        def close(records):
            parts, sample, size = [], [], 0
            for r in records:
                if size < sample_bytes:
                    sample.append(r[:sample_bytes])
                    size += len(sample[-1])
            trained = None
            if len(sample) < 16:
                every = b"".join(sample)
                piece = max(64, len(every) // 32)
                sample = [every[i: i + piece] for i in range(0, len(every), piece)]
            if len(sample) >= 16:
                try:
                    trained = zstandard.train_dictionary(dictionary_bytes, sample, d=8, k=256)
                except zstandard.ZstdError:  # samples too small or too alike
                    trained = None
            if trained is not None:
                raw = trained.as_bytes()
                parts.append(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
            c = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
            parts += [c.compress(r) for r in records]
            name = f"part-{TaskContext.get().partitionId():06d}-{number:04d}.warc.zst"
            return pa.record_batch([pa.array([name]), pa.array([b"".join(parts)], pa.binary())], names=["archive", "content"])

        number, size, records = 0, 0, []
        for b in batches:
            for page, html, refers in zip(b.column("page_id").to_pylist(), b.column("html"), b.column("refers_to").to_pylist()):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                kind = "response" if refers is None else "revisit"
                records.append(record(kind, f"urn:page:{'' if page is None else page}", f"page:{'' if page is None else page}", payload,
                                      None if refers is None else f"urn:page:{refers}"))
                size += len(payload)
                if size >= archive_bytes:
                    yield close(records)
                    number, size, records = number + 1, 0, []
        if records:
            yield close(records)

    return pages.select("page_id", "html", F.col("refers_to").cast("long").alias("refers_to")).mapInArrow(run, "archive string, content binary")


def frame_end(buf, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its header and block headers (RFC 8878)."""
    descriptor = buf[at + 4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    pos = at + 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + ((1 if single else 0), 2, 4, 8)[descriptor >> 6]
    while True:
        if pos + 3 > len(buf):
            raise ValueError("frame is cut off")
        head = buf[pos] | buf[pos + 1] << 8 | buf[pos + 2] << 16
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    pos += 4 * checksum
    if pos > len(buf):
        raise ValueError("frame is cut off")
    return pos


def dictionary(buf) -> tuple[bytes | None, int]:
    """The dictionary of the leading skippable frame, and where the records start."""
    import zstandard

    if len(buf) >= 8 and struct.unpack_from("<I", buf)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", buf, 4)[0]
        raw = bytes(buf[8: 8 + size])
        if len(raw) < size:
            raise ValueError("dictionary frame is cut off")
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        if raw[:4] != DICTIONARY_MAGIC:
            raise ValueError("leading frame holds no dictionary")
        return raw, 8 + size
    return None, 0


def skipped(buf, at: int) -> int | None:
    """Where the skippable frame at ``at`` ends, if it is one."""
    if len(buf) - at < 8 or struct.unpack_from("<I", buf, at)[0] & ~0xF != SKIPPABLE & ~0xF:
        return None
    end = at + 8 + struct.unpack_from("<I", buf, at + 4)[0]
    if end > len(buf):
        raise ValueError("skippable frame is cut off")
    return end


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record; ValueError if it isn't valid."""
    end = raw.find(b"\r\n\r\n")
    if end < 0 or not raw.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    head = {}
    for line in raw[:end].decode().split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError("bad header line")
        head[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in head:
            raise ValueError(f"no {name}")
    if not head["content-length"].isascii() or not head["content-length"].isdigit():
        raise ValueError("bad content-length")
    block, tail = raw[end + 4: -4], raw[-4:]
    if tail != b"\r\n\r\n" or len(block) != int(head["content-length"]):
        raise ValueError("length differs from content-length")
    if head["warc-type"] == "revisit":
        if block or "warc-refers-to" not in head or "warc-payload-digest" not in head:
            raise ValueError("bad revisit")
    elif "warc-payload-digest" in head and head["warc-payload-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("payload differs from its digest")
    return head, block


def read_archives(archives: DataFrame, name_col: str = "archive", content_col: str = "content", payload: bool = True) -> DataFrame:
    """A row for each record: its place, headers, payload, or what is wrong with it (``error``).

    Skippable frames between records are passed over.  A record that fails a
    check keeps its place and reads on at the next frame;
    an archive that is cut off ends with an error row.  Null or empty content
    has no records.  ``payload=False`` validates payloads but returns none.
    """
    def run(batches):
        import pyarrow as pa
        import zstandard

        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.string()]
        names = [x.split()[0] for x in RECORDS.split(", ")]
        for b in batches:
            for name, content in zip(b.column("archive").to_pylist(), b.column("content")):
                rows, held = [], 0
                buf = memoryview(content.as_buffer()).cast("B") if content.is_valid else memoryview(b"")
                at = 0
                try:
                    trained, at = dictionary(buf)
                    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
                    while at < len(buf):
                        if (end := skipped(buf, at)) is not None:
                            at = end
                            continue
                        if bytes(buf[at: at + 4]) != FRAME_MAGIC:
                            raise ValueError("no frame")
                        end = frame_end(buf, at)
                        try:
                            # streaming writers don't state a frame's content size
                            stream = reader.decompressobj()
                            raw = stream.decompress(buf[at:end])
                            if not stream.eof or stream.unused_data:
                                raise ValueError("frame ends elsewhere")
                            head, block = parse(raw)
                            rows.append((name, at, head["warc-type"], head["warc-record-id"].strip("<>"), head.get("warc-target-uri"),
                                         head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
                                         head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                         int(head.get("x-payload-length", len(block))), block if payload else None, None))
                            held += len(block) if payload else 0
                        except (ValueError, zstandard.ZstdError) as e:
                            rows.append((name, at, *[None] * 7, str(e)))
                        at = end
                        if len(rows) >= 1000 or held > 8 << 20:
                            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((name, at, *[None] * 7, str(e) or "frame is cut off"))
                if rows:
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

    return archives.select(F.col(name_col).alias("archive"), F.col(content_col).alias("content")).mapInArrow(run, RECORDS)
