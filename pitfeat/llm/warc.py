"""WARC archives: written and read as splittable text, boundaries verified as chains.

Writing. A record is one row of text; Spark's text writer puts the records of a
task into one file, each ended by two line breaks. Payloads that occur more than
once are stored once, in the response with the largest id; the others are
revisit records that name it.

Reading. Files are cut at every occurrence of the version line, wherever it
stands, so tasks find candidates without knowing where a record starts. Each
candidate that parses as a header names its successor: its place plus header and
content length. A candidate is a record only if a chain of such steps leads to
it from the start of its file, which rejects version lines inside payloads.
Steps within an input split are followed in the task; the few that leave a split
are resolved for all files at once by pointer jumping, each round doubling the
number of splits a pointer spans. Payloads are not shuffled for this: a second
pass over the files leaves out the pieces that turned out not to be whole
records, and only those are put together again.

Defined cases: a null payload is empty; empty payloads are compared like others.
Rows repeated with the same id become a response and revisits to it. A null id
or url is left out of the header and read back as null. An empty table gives no
records. Bytes after the last record that a chain reaches are left out. Other
columns are not read.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm.common import bounded, whole

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: rows of about 100 bytes up to which a side is broadcast
BROADCAST_ROWS = 200_000
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: forty bits, ten hex digits, make eight letters."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    clean = F.regexp_replace(value, "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    """Ids may be any text, so they are percent-encoded; the reader decodes them."""
    return F.concat(F.lit("<urn:page:"), F.url_encode(page_id.cast("string")), F.lit(">"))


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """One record (text) per row."""
    rows = pages.select(
        F.col(page_id).alias("_id"), F.col(url).cast("string").alias("_url"), whole(payload).alias("_body"))
    rows = rows.withColumns({
        "_row": F.monotonically_increasing_id(), "_size": F.octet_length("_body"),
        "_digest": base32_sha1(F.col("_body").cast("binary"))})
    groups = rows.groupBy("_digest", "_size").agg(
        F.max(F.struct("_id", "_row")).alias("_top"), F.count("*").alias("_n"))
    copies = groups.where("_n > 1").select(
        F.col("_digest").alias("_d"), F.col("_size").alias("_s"), "_top")
    if bounded(copies, BROADCAST_ROWS):
        copies = F.broadcast(copies)
    known = rows.join(copies, (F.col("_digest") == F.col("_d")) & (F.col("_size") == F.col("_s")), "left")
    again = F.col("_top").isNotNull() & (F.col("_top._row") != F.col("_row"))
    when_again = lambda c: F.when(again, c)
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("_id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("_url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        _line("WARC-Refers-To", when_again(_urn(F.col("_top._id")))),
        _line("WARC-Profile", when_again(F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(again, 0).otherwise(F.col("_size")).cast("string")),
        F.lit("\r\n"),
        F.when(again, "").otherwise(F.col("_body")),
    )
    return known.select(record.alias("value"))


def write_archives(pages: DataFrame, path: str, **names) -> None:
    """Write one archive per task into a folder; names as in ``records``."""
    records(pages, **names).write.option("lineSep", END).mode("overwrite").text(path)


# ---- reading

_PIECE = ("path string, split long, seq long, rel long, size long, parsed boolean, head int, length long, "
          "exit long, type string, id string, url string, digest string, refers string")


def _parse(piece: bytes) -> dict | None:
    """Header of a candidate, or None if it is none."""
    stop = piece.find(b"\r\n\r\n")
    if stop < 0:
        return None
    found = {}
    for line in piece[:stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        found[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = found.get(b"content-length", "")
    if not (length.isascii() and length.isdigit()) or len(length) > 15 or b"warc-type" not in found:
        return None
    return {
        "head": stop + 4, "length": int(length), "type": found[b"warc-type"],
        "id": _unwrap(found.get(b"warc-record-id")), "url": found.get(b"warc-target-uri"),
        "digest": (found.get(b"warc-payload-digest") or "").removeprefix("sha1:") or None,
        "refers": _unwrap(found.get(b"warc-refers-to")),
    }


def _unwrap(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:page:").removesuffix(">") if urn else None


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between version lines, with the input split it was found in."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("piece"))


def _numbered(batches):
    """(path, split, place in the split, piece) in order; a split's rows are contiguous."""
    at, seq = None, 0
    for b in batches:
        for path, split, piece in zip(
                b.column("path").to_pylist(), b.column("split").to_pylist(), b.column("piece")):
            if (path, split) != at:
                at, seq = (path, split), 0
            yield path, split, seq, piece.as_py()
            seq += 1


def _candidates(batches):
    """One row per piece, without its payload; ``exit`` is where a chain leaves the split."""
    fields = [f.split()[0] for f in _PIECE.split(", ")]

    def finished(rows: list[dict], end: int):
        place = {r["rel"]: r for r in rows}
        for r in reversed(rows):
            if r["parsed"]:
                to = r["rel"] + len(MAGIC) + r["head"] + r["length"] + len(END)
                r["exit"] = to if to >= end else place[to].get("exit") if to in place and to > r["rel"] else None
        return pa.RecordBatch.from_pylist([{k: r.get(k) for k in fields} for r in rows], schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _PIECE.split(", ")])
    rows, rel, at = [], 0, None
    for path, split, seq, piece in _numbered(batches):
        if (path, split) != at:
            if rows:
                yield finished(rows, rel - len(MAGIC))
            rows, rel, at = [], 0, (path, split)
        # a piece follows the version line at rel - len(MAGIC); the first of a file follows none
        parsed = None if split == 0 and seq == 0 else _parse(piece)
        rows.append({
            "path": path, "split": split, "seq": seq, "rel": rel - len(MAGIC), "size": len(piece),
            "parsed": parsed is not None, **(parsed or {})})
        rel += len(piece) + len(MAGIC)
    if rows:
        yield finished(rows, rel - len(MAGIC))


def _placed(found: DataFrame) -> DataFrame:
    """Candidates with places in the file instead of the split."""
    # one row per split: what lies before it in its file
    spans = found.groupBy("path", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("span"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = spans.select("path", "split", F.coalesce(F.sum("span").over(before), F.lit(0)).alias("base"))
    placed = found.join(F.broadcast(base) if bounded(base, BROADCAST_ROWS) else base, ["path", "split"])
    return placed.withColumns({"pos": F.col("base") + F.col("rel"), "exit": F.col("base") + F.col("exit")})


def _reached(placed: DataFrame) -> DataFrame:
    """Candidates that a chain reaches from the start of their file, and where they stop."""
    starts = placed.where("parsed")
    step = starts.where(F.col("exit").isNotNull()).select("path", "pos", "exit")
    targets = step.select("path", F.col("exit").alias("pos")).distinct()
    # only places that some split exits to, or a file starts at, can be entered
    jump = cut_lineage(step.join(targets, ["path", "pos"], "left_semi").unionByName(
        step.where("pos = 0")).distinct())
    entered = placed.select("path", F.lit(0).cast("long").alias("pos")).distinct()
    per_file = placed.groupBy("path").agg(F.count_distinct("split").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(per_file)) + 1 if per_file > 1 else 0):
        ahead = entered.join(jump, ["path", "pos"]).select("path", F.col("exit").alias("pos"))
        entered = cut_lineage(entered.unionByName(ahead).distinct())
        after = jump.select("path", F.col("pos").alias("exit"), F.col("exit").alias("further"))
        jump = cut_lineage(jump.join(after, ["path", "exit"]).select(
            "path", "pos", F.col("further").alias("exit")))

    marked = starts.join(entered.withColumn("entry", F.lit(True)), ["path", "pos"], "left")
    fields = ["path", "split", "seq", "pos", "size", "head", "length", "type", "id", "url", "digest", "refers"]

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        """The chain inside one split, from where it is entered."""
        pdf = pdf.sort_values("pos")
        stops = (pdf["pos"] + len(MAGIC) + pdf["head"] + pdf["length"] + len(END)).tolist()
        places = pdf["pos"].tolist()
        index = {p: i for i, p in enumerate(places)}
        kept, at = [], next((i for i, e in enumerate(pdf["entry"].tolist()) if e is True), None)
        while at is not None:
            kept.append(at)
            at = index.get(stops[at])
        out = pdf.iloc[kept][fields].copy()
        out["stop"] = [stops[i] for i in kept]
        return out

    schema = ("path string, split long, seq long, pos long, size long, head int, length long, type string, "
              "id string, url string, digest string, refers string, stop long")
    return cut_lineage(marked.groupBy("path", "split").applyInPandas(follow, schema))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """id, type, url, digest, refers, payload (binary) of every verified record."""
    found = cut_lineage(_pieces(spark, path).mapInArrow(_candidates, _PIECE))
    placed = _placed(found)
    kept = _reached(placed)
    whole_piece = F.col("stop") == F.col("pos") + len(MAGIC) + F.col("size")
    # pieces that are not a whole record by themselves: false starts, and records cut by them
    single = kept.where(whole_piece).select("path", "split", "seq")
    odd = cut_lineage(placed.where("seq > 0 or split > 0").join(single, ["path", "split", "seq"], "left_anti")
                      .select("path", "split", "seq", "pos"))
    keys = odd.select("path", "split", "seq")

    out = "path string, split long, seq long, id string, type string, url string, digest string, refers string, payload binary"

    def bodies(batches):
        names = ["path", "split", "seq", "id", "type", "url", "digest", "refers", "payload"]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary()]
        rows, held = [], 0
        schema = pa.schema(list(zip(names, kinds)))
        for file, split, seq, piece in _numbered(batches):
            if split == 0 and seq == 0:
                continue
            h = _parse(piece)
            if h is None or len(piece) != h["head"] + h["length"] + len(END):
                continue
            rows.append({"path": file, "split": split, "seq": seq, "payload": piece[h["head"]:-len(END)],
                         **{k: h[k] for k in ("id", "type", "url", "digest", "refers")}})
            held += len(piece)
            if held > 8_000_000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    fields = ["id", "type", "url", "digest", "refers", "payload"]
    plain = _pieces(spark, path).mapInArrow(bodies, out)
    small = bounded(keys, BROADCAST_ROWS)
    plain = plain.join(F.broadcast(keys) if small else keys, ["path", "split", "seq"], "left_anti")
    found = plain.select(*fields).unionByName(
        _assembled(spark, path, kept.where(~whole_piece), odd, small).select(*fields))
    return found.withColumns({c: F.try_url_decode(c) for c in ("id", "refers")})


def _assembled(spark: SparkSession, path: str, cut: DataFrame, odd: DataFrame, small: bool) -> DataFrame:
    """Records that hold version lines in their payload, put together from their pieces.

    A group is one record, so it is as large as its payload.
    """
    span = cut.select("path", F.col("pos").alias("first"), "stop", "head", "length",
                      "id", "type", "url", "digest", "refers")
    # the record a piece belongs to: the last one that begins at or before it
    here = Window.partitionBy("path").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    line = odd.select("path", "pos", "split", "seq", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"))
    line = line.unionByName(span.select(
        "path", F.col("first").alias("pos"), F.lit(None).cast("long").alias("split"),
        F.lit(None).cast("long").alias("seq"), F.lit(0).alias("kind"), "first"))
    owner = line.withColumn("first", F.last("first", ignorenulls=True).over(here)).where("kind = 1")
    owned = owner.join(span, ["path", "first"]).where("pos < stop")

    def number(batches):
        rows, held = [], 0
        schema = pa.schema([("path", pa.string()), ("split", pa.int64()), ("seq", pa.int64()), ("piece", pa.binary())])
        for p in _numbered(batches):
            rows.append(dict(zip(schema.names, p)))
            held += len(p[3])
            if held > 8_000_000:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    pieces = _pieces(spark, path).mapInArrow(number, "path string, split long, seq long, piece binary")
    parts = pieces.join(F.broadcast(owned) if small else owned, ["path", "split", "seq"])

    def join_up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        r = pdf.iloc[0]
        data = MAGIC.encode().join(pdf["piece"].tolist())
        row = {k: r[k] for k in ("id", "type", "url", "digest", "refers")}
        return pd.DataFrame([row | {"payload": data[r["head"]:r["head"] + r["length"]]}])

    return parts.groupBy("path", "first").applyInPandas(
        join_up, "id string, type string, url string, digest string, refers string, payload binary")


def page_report(found: DataFrame, id_type) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records that were read.

    A revisit takes the length from the response of its digest, which may have no id to
    be named by; its digest is the header's, a response's is computed from the payload.
    """
    full = found.where("type = 'response'").select(
        "id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    again = found.where("type = 'revisit'").select("id", "digest", "refers")
    named = full.groupBy(F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = again.join(named, "digest", "left").select(
        "id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers")
    rows = full.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers"))
    return rows.unionByName(revisits).select(
        F.col("id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers").cast(id_type).alias("refers_to"))
