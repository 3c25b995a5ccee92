"""Removal of passages that occur more than once, by external suffix sorting of content-defined shards.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else, in the same document or another; strings are judged on the
input. No shard of documents could find all of these, so shards are made of
places that can match:

1. Every window of ``length`` bytes has an anchor, its least gram by hash (see ``anchors``); equal windows have equal
   ones. Grams that occur once, most of them, end here.
2. The bytes that windows of an anchor can cover are its segment. Segments of one gram that are equal,
   by a 64-bit digest under a key drawn for the run, repeat as a whole; one of them goes on in place of all, however many there are.
3. The different segments of a gram meet in a shard. Those of a gram with more than ``block`` of them are narrowed first (see
   ``_narrowed``): to the windows that start at some of the places before the gram, in groups that share the bytes which all of
   these windows hold. Step 2 follows for each group, and groups that are still too large are narrowed again, down to single
   windows, which are equal in a group. So the work grows with the segments and not with their pairs.
4. A shard lays its segments out as one string, each byte of a document once, leaves out windows whose first or
   last 128 bytes occur nowhere else in the shard, and sorts the suffixes of the rest (``induced``). Windows that share
   ``length`` bytes with their neighbour in the order repeat.

Spans of all shards are merged per document. Row numbers stand for documents on the way, so ids may be null or repeated;
the documents are written once with their numbers, and every step reads those files.

Defined results: a null text is an empty one, and nothing is removed from texts shorter than ``length`` bytes; equal texts of that
length lose all of their bytes; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.anchors import GRAM, anchors, gram_hashes, segment_digests
from sedimenta.llm.common import free_name, give_back, plain_text, release, take_ragged, text_blocks, utf8_bytes, written
from sedimenta.llm.induced import DOUBLED, common_prefixes, suffix_array

LENGTH = 200
BLOCK = 1024
SHARD_SEGMENTS = 6000
# Parts that the windows of a large group are dealt to at a time, and segments whose bytes are hashed together.
PARTS, HASHED = 12, 2048
INNER = 128
# Spans that start in one such part of a text are merged before the spans of the text meet.
CHUNK_BITS = 20


def _number(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        yield batch.append_column(name, pa.array(np.arange(at, at + batch.num_rows)))
        at += batch.num_rows


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents, written with a number for each row (its partition and its place there), and that column's name."""
    name = free_name(docs, "__row")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return written(docs.mapInArrow(partial(_number, name=name), schema)), name


def _anchors(batches: Iterator[pa.RecordBatch], length: int, key: bytes) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text", 2 << 20):
        data, offsets = utf8_bytes(plain_text(block.column("text")))
        place, gram, around = anchors(data, offsets, length)
        row = np.searchsorted(offsets, place, side="right") - 1
        low, high, inner = periodic_runs(data, place, gram, row, length)
        place, gram, row = place[~inner], gram[~inner], row[~inner]
        segment = segment_digests(data, place, around[~inner], key)
        rows = block.column("row").to_numpy()
        yield pa.record_batch({
            "row": rows[row], "pos": (place - offsets[row]), "gram": gram.view(np.int64), "segment": segment.view(np.int64),
            "high": pa.nulls(len(row), pa.int64())})
        if len(low):
            row = np.searchsorted(offsets, low, side="right") - 1
            none = pa.nulls(len(row), pa.int64())
            yield pa.record_batch({"row": rows[row], "pos": low - offsets[row], "gram": none, "segment": none,
                                   "high": high - offsets[row]})


def periodic_runs(data: np.ndarray, place: np.ndarray, gram: np.ndarray, row: np.ndarray, length: int
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes that repeat themselves at a short distance, as spans, and which anchors stand inside them only.

    In a run longer than a window by its period every window starts again one period on, so the run is removed whole, and
    anchors whose windows all lie in it add nothing. Those near its ends stay, for the windows that reach over them and
    for equal windows elsewhere. Without this, a run of one byte would have an anchor at every byte.
    """
    none = np.zeros(0, np.int64)
    inner = np.zeros(len(place), bool)
    if len(place) < 3:
        return none, none, inner
    step = np.diff(place)
    held = (gram[1:] == gram[:-1]) & (row[1:] == row[:-1]) & (step <= GRAM)
    new = np.concatenate([[True], ~held[1:] | ~held[:-1] | (step[1:] != step[:-1])])
    first = np.flatnonzero(new & held)
    ends = np.append(np.flatnonzero(new), len(step))
    last = ends[np.searchsorted(ends, first, side="right")]
    long = place[last] + GRAM - place[first] >= length + step[first]
    low, high = [], []
    for a, b, period in zip(first[long].tolist(), last[long].tolist(), step[first[long]].tolist(), strict=True):
        begin, end = int(place[a]), int(place[b]) + GRAM
        if not np.array_equal(data[begin:end - period], data[begin + period:end]):
            continue  # grams that are equal by their hash only
        low.append(begin)
        high.append(end)
        own = place[a:b + 1]
        inner[a:b + 1] |= (own - (length - GRAM) >= begin) & (own + length <= end)
    return np.array(low, np.int64), np.array(high, np.int64), inner


def _held(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments around the wanted anchors of each text, as groups of all their windows for ``_narrowed``."""
    for block in text_blocks(batches, "text", 2 << 20):
        data, offsets = utf8_bytes(plain_text(block.column("text")))
        wanted = block.column("wanted")
        owner = np.repeat(np.arange(block.num_rows), np.diff(wanted.offsets.to_numpy()))
        every, rows = wanted.flatten().to_numpy(), block.column("row").to_numpy()
        for begin in range(0, len(every), HASHED):
            pos, text = every[begin:begin + HASHED], owner[begin:begin + HASHED]
            lead, start = np.minimum(pos, length - GRAM), offsets[text]
            end = np.minimum(start + pos + length, offsets[text + 1])
            yield pa.record_batch({
                "row": rows[text], "pos": pos, "first": pa.array(np.zeros(len(pos), np.int32)),
                "last": pa.array(np.full(len(pos), length - GRAM + 1, np.int32)), "lead": pa.array(lead, pa.int32()),
                "data": _pieces(data, start + pos - lead, end)})


def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end, as a binary column."""
    flat, cuts = take_ragged(data, np.append(np.stack([start, end], 1).ravel(), 0), 2 * np.arange(len(start)))
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(flat)])


def _narrowed(batches: Iterator[pa.RecordBatch], length: int, key: bytes) -> Iterator[pa.RecordBatch]:
    """Segments of large groups, each as its parts: some of the windows, their group and a digest of their bytes.

    A part holds the windows that start from ``first`` up to before ``last`` bytes before the anchor. Its group is a hash of the bytes that all of
    these hold, so equal windows stay together. Both hashes are sums of the bytes times secret numbers of their places, which lie
    at the same distance from the anchor in all members of a group: who does not know the numbers makes
    two parts that are wrongly taken as equal with a chance of 2**-56.
    """
    reach = length - GRAM + 1
    width = reach - 1 + length  # column reach - 1 is the anchor's
    secret = np.frombuffer(hashlib.shake_256(key).digest(8 * (width + 3)), "<u8")
    for batch in batches:
        for begin in range(0, batch.num_rows, HASHED):
            part = batch.slice(begin, HASHED)
            first, last, lead = (part.column(c).to_numpy().astype(np.int64) for c in ("first", "last", "lead"))
            size = pc.binary_length(part.column("data")).to_numpy().astype(np.int64)
            starts = np.cumsum(size) - size
            flat = np.frombuffer(b"".join(part.column("data").to_pylist()), np.uint8)
            tail, every = size - lead, np.arange(len(size))
            sums = np.zeros((len(size), width + 1), np.uint64)
            column = np.arange(len(flat)) + np.repeat(reach - 1 - lead - starts, size)
            sums[np.repeat(every, size), column + 1] = flat * secret[column]
            np.cumsum(sums, axis=1, out=sums)
            step = -(-(last - first) // PARTS)
            for number in range(PARTS):
                low = first + number * step
                high = np.minimum(low + step, last)
                good = np.flatnonzero((low < high) & (np.maximum(low, length - tail) < np.minimum(high, lead + 1)))
                a, b, w = low[good], high[good], reach - 1
                before, after = np.minimum(lead[good], b - 1), np.minimum(tail[good], length - a)
                core = sums[good, w + length - b + 1] - sums[good, w - a] + secret[-1] * a.astype(np.uint64)
                whole = (sums[good, w + after] - sums[good, w - before] + secret[-2] * before.astype(np.uint64)
                         + secret[-3] * after.astype(np.uint64))
                middle = starts[good] + lead[good]
                yield pa.record_batch({
                    "key": core.view(np.int64), "segment": whole.view(np.int64),
                    "row": part.column("row").take(pa.array(good)), "pos": part.column("pos").take(pa.array(good)),
                    "first": pa.array(a, pa.int32()), "last": pa.array(b, pa.int32()), "lead": pa.array(before, pa.int32()),
                    "data": _pieces(flat, middle - before, middle + after)})


def _cut_segments(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The wanted bytes of each text, packed for the shards they go to."""
    for block in text_blocks(batches, "text", 2 << 20):
        data, offsets = utf8_bytes(plain_text(block.column("text")))
        rows = block.column("row").to_numpy()
        wanted = block.column("wanted")
        owner = np.repeat(np.arange(block.num_rows), np.diff(wanted.offsets.to_numpy()))
        shard = wanted.flatten().field("shard").to_numpy()
        start = wanted.flatten().field("low").to_numpy() + offsets[owner]
        end = np.minimum(wanted.flatten().field("high").to_numpy() + offsets[owner], offsets[owner + 1])
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], shard[order][1:] != shard[order][:-1]])) if len(order) else []
        ids, blobs = [], []
        for part in np.split(order, cuts[1:]) if len(order) else []:
            numbers = np.stack([rows[owner[part]], start[part] - offsets[owner[part]], end[part] - start[part]])
            head = np.array([len(part)], "<i8").tobytes() + numbers.astype("<i8").tobytes()
            body = b"".join(data[a:b].tobytes() for a, b in zip(start[part], end[part], strict=True))
            ids.append(int(shard[part[0]]))
            blobs.append(zstandard.compress(head + body, 1))
        yield pa.record_batch({"shard": pa.array(ids, pa.int32()), "data": pa.array(blobs, pa.binary())})


def lay_out(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, body: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments, each a part of a row, as runs without overlaps: bytes, offsets, and each run's row and start."""
    order = np.lexsort((starts, rows))
    where = (np.cumsum(lengths) - lengths)[order]
    rows, starts, lengths = rows[order], starts[order], lengths[order]
    ends = starts + lengths
    # The furthest end so far in the row; rows are ascending, so a shift by row keeps the rows apart.
    shift = (np.cumsum(np.concatenate([[0], rows[1:] != rows[:-1]]))) * np.int64(1 << 40)
    reach = np.maximum.accumulate(ends + shift) - shift
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (starts[1:] > reach[:-1])])
    fresh = np.where(new, starts, np.concatenate([[0], reach[:-1]]))
    count = np.maximum(ends - fresh, 0)
    place = np.repeat(where + fresh - starts - (np.cumsum(count) - count), count) + np.arange(count.sum())
    runs = np.flatnonzero(new)
    sizes = np.add.reduceat(count, runs)
    return body[place], np.concatenate([[0], np.cumsum(sizes)]), rows[runs], starts[runs]


def promising(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Ascending window starts that may repeat: their first and their last ``INNER`` bytes each occur again, by a hash.

    Windows left out have no equal, so they need no place in the suffix order.
    """
    inner = max(min(INNER, length), GRAM)
    grams = gram_hashes(data)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    at = np.flatnonzero(room >= inner)
    held = (grams[at] * np.uint64(0x9E3779B97F4A7C15)) ^ grams[at + inner - GRAM]
    order = np.argsort(held)
    ranked = held[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(data), bool)
    twice[at[order[1:][same]]] = True
    twice[at[order[:-1][same]]] = True
    starts = np.flatnonzero(room >= length)
    return starts[twice[starts] & twice[starts + length - inner]]


def covered(starts: np.ndarray, length: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans covered by strings of ``length`` bytes from ascending starts; none crosses a run."""
    if not len(starts):
        return starts, starts
    run = np.searchsorted(offsets, starts, side="right")
    new = np.concatenate([[True], (starts[1:] > starts[:-1] + length) | (run[1:] != run[:-1])])
    return starts[new], starts[np.append(new[1:], True)] + length


def _sort_shard(group: pd.DataFrame, length: int) -> pd.DataFrame:
    heads, bodies = [], []
    for data in group["data"]:
        plain = zstandard.decompress(data)
        count = int(np.frombuffer(plain, "<i8", 1)[0])
        heads.append(np.frombuffer(plain, "<i8", 3 * count, 8).reshape(3, count))
        bodies.append(np.frombuffer(plain, np.uint8, offset=8 + 24 * count))
    rows, starts, lengths = np.hstack(heads)
    data, offsets, run_row, run_start = lay_out(rows, starts, lengths, np.concatenate(bodies))
    found = repeated_windows(data, offsets, length)
    low, high = covered(found, length, offsets)
    run = np.searchsorted(offsets, low, side="right") - 1
    shift = run_start[run] - offsets[run]
    give_back()
    return pd.DataFrame({"row": run_row[run], "low": low + shift, "high": high + shift})


def repeated_windows(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Ascending starts of the strings of ``length`` bytes inside a run that start more than once."""
    low, high = covered(promising(data, offsets, length), length, offsets)
    if not len(low):
        return np.zeros(0, np.int64)
    sizes = high - low
    place = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    # Runs are parted by a symbol below every byte.
    text = np.insert(data[place].astype(np.int64) + 1, np.cumsum(sizes), 0)
    back = np.insert(place, np.cumsum(sizes), 0)
    ends = np.cumsum(sizes) + np.arange(len(sizes))
    room = np.repeat(ends, sizes + 1) - np.arange(len(text))
    order = suffix_array(text, short=DOUBLED)
    order = order[room[order] >= length]
    common = common_prefixes((text - (text > 0)).astype(np.uint8), order, room, length)
    again = common >= length
    twice = again.copy()
    twice[:-1] |= again[1:]
    return np.sort(back[order[twice]])


def repeated_spans(texts: DataFrame, length: int = LENGTH, block: int = BLOCK,
                   shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """(row, low, high): spans of bytes to remove from written texts (row, text); they may overlap. Written."""
    if length < GRAM:
        raise ValueError(f"strings have at least {GRAM} bytes")
    spark = texts.sparkSession
    key = secrets.token_bytes(16)
    found = written(texts.mapInArrow(partial(_anchors, length=length, key=key), "row long, pos long, gram long, segment long, high long"))
    runs = written(found.where("gram is null").select("row", F.col("pos").alias("low"), "high"))
    placed = found.where("gram is not null").drop("high")
    # Written, like `several` below: an aggregate right below a join would keep AQE from splitting its hot grams.
    met = written(placed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"))
    shared = written(placed.join(met, "gram"))
    release(spark, found)

    # One entry for each different segment, and the entries of the grams that have several.
    entries = written(shared.groupBy("gram", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "pos")).alias("first")))
    copies = entries.where("n > 1").select("gram", "segment")
    whole = written(shared.join(copies, ["gram", "segment"]).select(
        "row", F.greatest(F.col("pos") - (length - GRAM), F.lit(0)).alias("low"),
        (F.col("pos") + length).alias("high")))
    several = written(entries.groupBy("gram").agg(F.count(F.lit(1)).alias("many")).where("many > 1"))
    varied = written(entries.join(several, "gram").select("gram", "many", "first.row", "first.pos"))
    release(spark, shared, entries)

    low = F.greatest(F.col("pos") - (length - GRAM), F.lit(0))
    meeting = varied.where(F.col("many") <= block).select("row", low.alias("low"), (F.col("pos") + length).alias("high"), F.col("gram").alias("key"))
    parts, repeated = _narrow(texts, varied.where(F.col("many") > block), length, block, key)
    dealt = written(reduce(DataFrame.unionAll, [meeting, *parts]))
    release(spark, varied, *parts)
    shards = max(-(-dealt.count() // shard_segments), 1)
    wanted = dealt.select("row", "low", "high", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")).distinct()
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("low", "high", "shard")).alias("wanted"))
    joined = texts.join(lists, "row").select("row", "text", "wanted")
    segments = joined.mapInArrow(partial(_cut_segments, shards=shards), "shard int, data binary")
    sorted_spans = segments.groupBy("shard").applyInPandas(
        lambda group: _sort_shard(group, length), "row long, low long, high long")
    partly = written(sorted_spans)
    release(spark, dealt)
    return reduce(DataFrame.unionAll, [whole, *repeated, partly, runs])


def _narrow(texts: DataFrame, large: DataFrame, length: int, block: int, key: bytes) -> tuple[list[DataFrame], list[DataFrame]]:
    """(row, low, high, key) to sort, at most ``block`` of a key, in place of the segments (row, pos) of large groups, and the spans found to
    repeat on the way. Written."""
    spark, parts, repeated = texts.sparkSession, [], []
    if large.isEmpty():
        return parts, repeated
    wanted = large.groupBy("row").agg(F.collect_list("pos").alias("wanted"))
    fields = "row long, pos long, first int, last int, lead int, data binary"
    groups = written(texts.join(wanted, "row").select("row", "text", "wanted").mapInArrow(partial(_held, length=length), fields))
    span = ["row", F.greatest(F.col("pos") - F.col("last") + 1, F.lit(0)).alias("low"), (F.col("pos") + length - F.col("first")).alias("high")]
    while True:
        made = written(groups.mapInArrow(partial(_narrowed, length=length, key=key), f"key long, segment long, {fields}"))
        entries = written(made.groupBy("key", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "pos")).alias("one")))
        copies = entries.where("n > 1").select("key", "segment")
        repeated.append(written(made.join(copies, ["key", "segment"]).select(*span)))
        several = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1"))
        ones = entries.join(several, "key").select("key", "many", "one.row", "one.pos")
        varied = written(made.join(ones, ["key", "row", "pos"]))
        parts.append(written(varied.where(F.col("many") <= block).select(*span, "key")))
        used, groups = groups, written(varied.where(F.col("many") > block).select(*made.columns[2:]))
        release(spark, used, made, entries, varied)
        if groups.isEmpty():
            return parts, repeated


def _merge(spans: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans inside a text of ``size`` bytes."""
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.array([s["low"] for s in spans])
    high = np.minimum(np.array([s["high"] for s in spans]), size)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > high[:-1]])
    return low[new], high[np.append(new[1:], True)]


def _kept(text: str | None, spans: list | None) -> tuple[bytes, int, int]:
    """Bytes kept, how many are removed, and in how many spans."""
    data = (text or "").encode()
    low, high = _merge(spans or [], len(data))
    edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return kept, len(data) - len(kept), len(low)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text"):
        out = [(_kept(t, s)) for t, s in zip(block.column("text").to_pylist(), block.column("spans").to_pylist(),
                                             strict=True)]
        yield pa.record_batch({
            "doc_id": block.column("doc_id"), "n_bytes": pa.array([len(k) + r for k, r, _ in out], pa.int64()),
            "n_removed": pa.array([r for _, r, _ in out], pa.int64()),
            "n_spans": pa.array([n for _, _, n in out], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k, _, _ in out], pa.string())})


def merged_spans(spans: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The same spans without overlaps among those that start in one chunk of a row: a row has few, however many cover it."""
    order = Window.partitionBy("row", "chunk").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("chunk", F.shiftright("low", chunk_bits)).withColumn(
        "opens", F.coalesce((F.col("low") > reach).cast("int"), F.lit(1)))
    numbered_ = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered_.groupBy("row", "chunk", "span").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _span_lists(spans: DataFrame) -> DataFrame:
    return merged_spans(spans).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def digest(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """doc_id, sizes and the checksum of the bytes kept of every document."""
    rows, number = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    texts = rows.withColumnRenamed(number, "row")
    spans = repeated_spans(texts.select("row", "text"), length, **sizes)
    found = texts.join(_span_lists(spans), "row", "left").select("doc_id", "text", "spans")
    return found.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _rewrite(batches: Iterator[pa.RecordBatch], names: list[str], spans_name: str) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text"):
        texts, spans = block.column("text").to_pylist(), block.column(spans_name).to_pylist()
        kept = [t if not s else _kept(t, s)[0].decode(errors="ignore") for t, s in zip(texts, spans, strict=True)]
        columns = [pa.array(kept, pa.string()) if n == "text" else block.column(n) for n in names]
        yield pa.record_batch(columns, names)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with their repeated passages cut out of ``text``; all rows and columns stay.

    A character cut in two by the end of a passage goes with it. A column n_chars, if there is one, is counted again.
    """
    rows, number = numbered(docs)
    spans = repeated_spans(rows.select(F.col(number).alias("row"), "text"), length)
    name = free_name(rows, "__spans")
    lists = _span_lists(spans).select(F.col("row").alias(number), F.col("spans").alias(name))
    joined = rows.join(lists, number, "left").select(*docs.columns, name)
    cut = joined.mapInArrow(partial(_rewrite, names=docs.columns, spans_name=name), docs.schema)
    if "n_chars" in docs.columns:
        counted = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", counted)
    return cut.select(docs.columns)
