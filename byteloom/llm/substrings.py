"""Removing long repeated strings of bytes by blockwise suffix arrays.

1.  Every window of LENGTH bytes picks the least hash among its runs of ANCHOR
    bytes.  Equal windows pick equal anchors at equal places, so only windows
    whose anchor occurs again can repeat; all others are settled here.
2.  Neighbouring windows with one anchor form a segment.  Equal segments are
    counted; segments with one anchor but different bytes go to one bucket.
3.  A bucket is one suffix-array block (see `suffixarray`): its windows are
    sorted with ties resolved by difference-cover ranks, and neighbours that
    share LENGTH bytes are marked.  Anchors with more than BUCKET_SEGMENTS
    different segments are settled by counting digests of their windows
    instead, so no block grows with the corpus.
4.  Marked windows are taken out of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common, suffixarray

LENGTH, ANCHOR = 400, 64
#: Different segments of one anchor in a suffix-array block.
BUCKET_SEGMENTS = 4096
#: Segments in a block, of all its anchors.
BLOCK_SEGMENTS = 8_000
#: Bytes of a text whose windows are found at once.
CHUNK = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(factors)


_UP = _powers(_BASE, CHUNK + 1024)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1024)


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """A hash of every run of `anchor` bytes, by differences of one running sum."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * _DOWN[: len(data)], out=total[1:])
        h = (total[anchor:] - total[:-anchor]) * _UP[: len(data) - anchor + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


def window_runs(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor hash, anchor's place) of all runs of windows with one anchor."""
    out: list[tuple] = []
    width = length - anchor + 1
    raw = np.frombuffer(data, np.uint8)
    for chunk in range(0, max(0, len(raw) - length + 1), CHUNK):
        piece = raw[chunk : chunk + CHUNK + length - 1].astype(np.uint64)
        h = anchor_hashes(piece, anchor)
        n = len(h) - width + 1
        keyed = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max)
        keyed[: len(h)] = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        rows = keyed.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _PLACE).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        windows = np.diff(np.append(start, n))
        out.append((start + chunk, windows, h[place[start]].view(np.int64), place[start] + chunk))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _digest(data) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, body): a row is its id and its text; NULL ids are marked, not lost."""
    body = common.text_of(text_col)
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(body, F.col(id_col).isNull()).alias("text_key"),
        body.cast("binary").alias("body"),
    )


def _anchors(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [window_runs(t.as_buffer(), length, anchor)[2] for t in batch.column(0) if len(t.as_buffer()) >= length]
            if held:
                found, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["anchor", "n"])

    return (
        rows.select("body").mapInArrow(run, "anchor bigint, n bigint")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    )


def _segments(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """(id, text_key, start, windows, place, anchor, a, b): every segment with a digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, parts, digests = [], [], []
            for i, t in enumerate(batch.column(2)):
                data = t.as_buffer()
                if len(data) < length:
                    continue
                start, windows, hashed, place = window_runs(data, length, anchor)
                view = memoryview(data)
                digests += [_digest(view[s:e]) for s, e in zip(start.tolist(), (start + windows + length - 1).tolist())]
                parts.append((start, windows, place - start, hashed))
                which.append(np.full(len(start), i))
            if not parts:
                continue
            start, windows, place, hashed = (np.concatenate(x) for x in zip(*parts))
            ab = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            which = pa.array(np.concatenate(which))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(which), batch.column(1).take(which), pa.array(start), pa.array(windows.astype(np.int32)),
                    pa.array(place.astype(np.int32)), pa.array(hashed), pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy()),
                ],
                ["id", "text_key", "start", "windows", "place", "anchor", "a", "b"],
            )

    return rows.mapInArrow(
        run, "id bigint, text_key bigint, start bigint, windows int, place int, anchor bigint, a bigint, b bigint"
    )


_PART = "id bigint, text_key bigint, start bigint, windows int"


def _cut(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments with their bytes; a text is read once for all of them."""
    lists = wanted.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "windows", "place", "anchor", "kinds")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, bodies, parts = batch.columns
            out: list[dict] = []
            for i in range(batch.num_rows):
                data = memoryview(bodies[i].as_buffer())
                for p in parts[i].as_py():
                    end = p["start"] + p["windows"] + LENGTH - 1
                    out.append(p | {"id": ids[i].as_py(), "text_key": keys[i].as_py(), "bytes": bytes(data[p["start"] : end])})
                if len(out) > 5_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema(
        [("id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("anchor", pa.int64()),
         ("place", pa.int32()), ("kinds", pa.int64()), ("bytes", pa.binary())]
    )
    return rows.join(lists, ["id", "text_key"]).mapInArrow(run, f"{_PART}, anchor bigint, place int, kinds bigint, bytes binary")


def _by_blocks(cut: DataFrame, length: int) -> DataFrame:
    """(id, text_key, start, windows): runs of repeated windows, from suffix-array blocks."""
    blocks = max(1, -(-cut.count() // BLOCK_SEGMENTS))

    def run(table: pa.Table) -> pa.Table:
        seen: set = set()
        picked = []
        for i, key in enumerate(zip(*(table[c].to_pylist() for c in ("id", "text_key", "start")))):
            if key not in seen:
                seen.add(key)
                picked.append(i)
        table = table.take(picked)
        pieces = table["bytes"].to_pylist()
        # Every anchor lies on a multiple of the period, so equal windows have one residue.
        period, offset, end = suffixarray.PERIOD, [], 0
        for i, place in enumerate(table["place"].to_pylist()):
            gap = -(end + place) % period
            pieces[i] = bytes(gap) + pieces[i]
            offset.append(end + gap)
            end += len(pieces[i])
        offset = np.array(offset, np.int64)
        windows = table["windows"].to_numpy().astype(np.int64)
        starts = np.concatenate([np.arange(o, o + w) for o, w in zip(offset, windows)])
        marked = suffixarray.repeated(b"".join(pieces), starts, length)
        # Windows of segments that occur as they are more than once repeat anyway.
        owner = np.repeat(np.arange(len(pieces)), windows)
        within = np.arange(len(starts)) - np.repeat(np.cumsum(windows) - windows, windows)
        edge = np.flatnonzero(marked & np.concatenate([[True], ~marked[:-1] | (owner[1:] != owner[:-1])]))
        stop = np.flatnonzero(marked & np.concatenate([~marked[1:] | (owner[1:] != owner[:-1]), [True]]))
        own = owner[edge]
        at = table["start"].to_numpy()[own] + within[edge]
        return pa.table(
            {"id": table["id"].take(own), "text_key": table["text_key"].take(own), "start": pa.array(at), "windows": pa.array((stop - edge + 1).astype(np.int32))}
        )

    return (
        cut.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(run, _PART)
    )


def _by_digests(cut: DataFrame, length: int) -> DataFrame:
    """The same for anchors of many segments: windows whose digest occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("id", "text_key", "start", "windows", "bytes")}
                n, view = row["windows"], memoryview(row["bytes"])
                ab = np.frombuffer(b"".join(_digest(view[j : j + length]) for j in range(n)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["id"])), pa.array(np.full(n, row["text_key"])), pa.array(row["start"] + np.arange(n)),
                        pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy()),
                    ],
                    ["id", "text_key", "start", "a", "b"],
                )

    windows = cut.dropDuplicates(["id", "text_key", "start"]).mapInArrow(
        run, "id bigint, text_key bigint, start bigint, a bigint, b bigint"
    )
    again = windows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    return windows.join(again, ["a", "b"]).select("id", "text_key", "start", F.lit(1).alias("windows"))


def repeated_windows(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(id, text_key, start, windows): runs of windows that also start anywhere else."""
    # Both sides of the joins come from shuffles of their own, so that Spark can split a hot anchor.
    again = common.checkpointed(_anchors(rows, length, anchor))
    found = common.checkpointed(_segments(rows, length, anchor).join(again, "anchor"))
    kinds = found.groupBy("anchor", "a", "b").agg(
        F.count("*").alias("times"), F.min(F.struct("id", "text_key", "start", "windows", "place")).alias("first")
    )
    whole = found.join(kinds.where("times > 1").select("anchor", "a", "b"), ["anchor", "a", "b"], "left_semi")
    kinds = common.checkpointed(kinds)
    many = common.checkpointed(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    mixed = kinds.join(many, "anchor").select("anchor", "kinds", "first.*")
    cut = common.checkpointed(_cut(rows, mixed))
    few = F.col("kinds") <= BUCKET_SEGMENTS
    return (
        whole.select("id", "text_key", "start", "windows")
        .union(_by_blocks(cut.where(few), length))
        .union(_by_digests(cut.where(~few), length))
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and `kept` (the bytes that stay), per row.

    Texts are UTF-8 bytes; NULL is the empty text.  A byte goes if it lies in a
    string of `length` bytes that also starts anywhere else, in the same text
    or another; strings are judged on the input, and overlaps count.  Texts
    shorter than `length` stay whole.  Repeated rows count as copies of each
    other.  An empty table gives an empty result.
    """
    if not 8 <= anchor < length:
        raise ValueError("an anchor of 8 bytes or more, shorter than the strings")
    rows = _keyed(docs, id_col, text_col)
    spans = repeated_windows(rows, length, anchor).groupBy("id", "text_key").agg(
        F.collect_list(F.struct("start", "windows")).alias("spans")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, null, body, found in zip(*batch.columns):
                data = memoryview(body.as_buffer())
                kept, at, removed, n = [], 0, 0, 0
                if found.is_valid:
                    both = found.values.flatten()
                    start, windows = both[0].to_numpy(), both[1].to_numpy().astype(np.int64)
                    order = np.argsort(start, kind="stable")
                    start = start[order]
                    end = np.maximum.accumulate(start + windows[order] + length - 1)
                    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                    for s, e in zip(start[first].tolist(), end[np.append(first[1:], len(end)) - 1].tolist()):
                        kept.append(data[at:s])
                        removed, n, at = removed + e - s, n + 1, e
                kept = b"".join([*kept, data[at:]])
                out.append((None if null.as_py() else id_.as_py(), len(data), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    joined = rows.join(spans, ["id", "text_key"], "left")
    null_id = F.col("text_key") == F.xxhash64(F.col("body").cast("string"), F.lit(True))
    return (
        joined.select("id", ((F.col("id") == 0) & null_id).alias("null_id"), "body", "spans")
        .mapInArrow(run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
        .withColumnRenamed("id", id_col)
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur twice, removed from all documents.

    `kept_text` shows the bytes that stay; a character that was cut through is
    shown by the replacement character.
    """
    found = remove_repeats(common.table(spark, sf_dir, "documents"))
    return found.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")
