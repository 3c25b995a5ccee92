"""Collocations: frequent phrases of two to four words, counted exactly by counting quotient filters.

1. Texts are packed into shards of some megabytes: a stream of word codes, broken at piece ends, and the shard's
   vocabulary with counts. A text longer than a shard goes on in the next one, which repeats its last words for the
   phrases that reach over the border.
2. Vocabularies are summed per (lang, word). Words that are frequent enough to be in a candidate get ids
   without gaps, and every shard gets the ids of its own words back.
3. A shard counts its pairs of frequent words in quotient filters, cut by ranges of permuted keys. Each range
   merges the filters of all shards, and tells every shard which of its pairs are frequent.
4. Phrases of three and four words are counted in the same way, where all pairs inside them are frequent: no other one can be.
5. Parts, cuts, longer phrases and texts of the candidates are joins of the counted phrases.

Only shard vocabularies, filters and frequent phrases are shuffled; a phrase that makes up a third of the
corpus is one entry a shard.

Defined results: a null or empty text has no words; a null lang is ``und``. Equal rows count as often as they come. Equal scores
go by count, then by the phrase's bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm import quotient_filter as qf
from sedimenta.llm.common import give_back, plain_text, release, shuffle_partitions, text_blocks, utf8_bytes, written
from sedimenta.sources.scratch import new_scratch

MIN_COUNT, TOP, LONGEST = 30, 2000, 4
SCORE_SCALE, COVER_PERCENT = 2_000_000, 80
NO_LANG = "und"
# Bytes of text in a shard, and for which there is one range of keys; the least number of ranges, as a power of two.
SHARD_BYTES, RANGE_BYTES, MIN_RANGE_BITS = 4 << 20, 16 << 20, 6
# Bytes of text whose shards one task gets: Arrow hands them over together.
TASK_BYTES = 8 << 20

SHARDS = "shard long, n_bytes long, fresh long, codes binary, vocabulary array<struct<lang:string,word:string,n:long>>"
COUNTED = "kind string, shard long, range int, words int, fresh long, data binary"
MERGED = "kind string, shard long, words int, w1 long, w2 long, w3 long, w4 long, f long, data binary"
KEY = ["w1", "w2", "w3", "w4"]

# What a byte is: 0 inside a word, 1 between words, 2 the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


# --- shards ---------------------------------------------------------------------------------

def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text."""
    held, total = [], 0
    for block in text_blocks(batches, "text", max(size // 4, 1)):
        held.append(block)
        total += pc.sum(pc.fill_null(pc.binary_length(block.column("text")), 0)).as_py()
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words, and whether a piece ends between a word and the one before it."""
    kind = _KIND[data]
    inside, edge = kind == 0, np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    # A part of a text, at most some megabytes: places have 32 bits.
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))).astype(np.int32)
    ends = (np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1).astype(np.int32)
    rows = (np.searchsorted(offsets, starts, side="right") - 1).astype(np.int32)
    stops = np.flatnonzero(kind == 2).astype(np.int32)
    parted = np.ones(len(starts), bool)
    parted[1:] = (np.searchsorted(stops, starts[1:]) > np.searchsorted(stops, ends[:-1])) | (rows[1:] != rows[:-1])
    return starts, ends, rows, parted


def _shard(data: np.ndarray, offsets: np.ndarray, langs: list[str], lang_of: np.ndarray, again: int) -> dict:
    """One shard of these rows; its first ``again`` words have been counted in the shard before."""
    starts, ends, rows, parted = _words(data, offsets)
    size = ends - starts
    ends_at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    held = _LOWER[data[_KIND[data] == 0]]
    coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at), pa.py_buffer(held)).dictionary_encode()
    word, count = np.asarray(coded.indices), len(coded.dictionary)
    pair = lang_of[rows] * max(count, 1) + word
    pairs = np.flatnonzero(np.bincount(pair))
    code_of = np.zeros(int(pairs[-1]) + 1 if len(pairs) else 0, np.int32)
    code_of[pairs] = np.arange(len(pairs))
    code = code_of[pair]
    n = np.bincount(code[again:], minlength=len(pairs))
    vocabulary = pa.StructArray.from_arrays(
        [pa.array(langs, pa.string()).take(pa.array(pairs // max(count, 1))),
         coded.dictionary.take(pa.array(pairs % max(count, 1))).cast(pa.string()), pa.array(n, pa.int64())],
        ["lang", "word", "n"])
    place = np.arange(len(code)) + np.cumsum(parted)
    stream = np.zeros(len(code) + int(parted.sum()), np.int32)
    stream[place] = code + 1
    return {"n_bytes": len(data), "fresh": int(place[again]) if again < len(place) else len(stream) if again else 0,
            "codes": zstandard.compress(stream.tobytes(), 1), "vocabulary": vocabulary}


def _long_row(data: np.ndarray, langs: list[str], size: int) -> Iterator[dict]:
    """Shards of one row; each repeats the last words of the one before."""
    begin, end, again = 0, 0, 0
    while end < len(data):
        end = min(end + size, len(data))
        while end < len(data):
            ahead = np.flatnonzero(_KIND[data[end:end + size]])
            end = end + int(ahead[0]) if len(ahead) else min(end + size, len(data))
            if len(ahead):
                break
        part = data[begin:end]
        yield _shard(part, np.array([0, len(part)]), langs, np.zeros(1, np.int64), again)
        starts, *_ = _words(part, np.array([0, len(part)]))
        again = min(len(starts), LONGEST - 1)
        begin = begin + int(starts[-again]) if again else end


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << 32
    for batch in _gathered(batches, size):
        data, offsets = utf8_bytes(plain_text(batch.column("text")))
        lang = pc.fill_null(batch.column("lang").cast(pa.string()), NO_LANG).dictionary_encode()
        langs, lang_of = lang.dictionary.to_pylist(), np.asarray(lang.indices, np.int64)
        made = (_long_row(data, langs, size) if batch.num_rows == 1 and len(data) > size
                else [_shard(data, offsets, langs, lang_of, 0)])
        for shard in made:
            vocabulary = shard.pop("vocabulary")
            yield pa.record_batch({
                "shard": pa.array([at], pa.int64()), **{k: pa.array([v]) for k, v in shard.items()},
                "vocabulary": pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary)})
            at += 1
            give_back()


# --- counting -------------------------------------------------------------------------------

def _stream(codes: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(codes), np.int32)


def _windows(ids: np.ndarray, good: np.ndarray, words: int, fresh: int) -> np.ndarray:
    """Starts of the runs of so many words whose pairs are all good, and that end at ``fresh`` or later."""
    size = len(ids) - words + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    held = reduce(np.logical_and, [good[n:n + size] for n in range(words - 1)])
    at = np.flatnonzero(held)
    return at[at + words - 1 >= fresh]


def _filters(ids: np.ndarray, at: np.ndarray, words: int, range_bits: int) -> list[tuple[int, bytes]]:
    upper, lower = qf.permute([ids[at + n] for n in range(words)])
    if words == 2:
        upper, counts = np.unique(upper, return_counts=True)
        return qf.cut(upper, np.zeros(len(upper), np.uint64), counts, words, range_bits)
    return qf.cut(*qf.summed(upper, lower, np.ones(len(upper), np.int64)), words, range_bits)


def _counted_rows(shard: int, words: int, filters: list[tuple[int, bytes]], fresh: int = 0, ids: np.ndarray | None = None
                  ) -> pa.RecordBatch:
    rows = [("filter", shard, number, words, 0, data) for number, data in filters]
    if ids is not None:
        rows.append(("stream", shard, -1, 0, fresh, zstandard.compress(ids.astype(np.uint32).tobytes(), 1)))
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                           ["kind", "shard", "range", "words", "fresh", "data"])


def _count_pairs(batches: Iterator[pa.RecordBatch], range_bits: int) -> Iterator[pa.RecordBatch]:
    """Streams of the shards in ids, 0 for words that are not frequent, and the filters of their pairs."""
    for batch in batches:
        for number in range(batch.num_rows):
            row = batch.slice(number, 1)
            known = row.column("known").flatten()
            codes = _stream(row.column("codes")[0].as_py())
            id_of = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
            id_of[known.field("at").to_numpy(zero_copy_only=False) + 1] = known.field("id").to_numpy(zero_copy_only=False)
            ids, fresh = id_of[codes], row.column("fresh")[0].as_py()
            good = (ids[1:] > 0) & (ids[:-1] > 0)
            yield _counted_rows(row.column("shard")[0].as_py(), 2,
                                _filters(ids, _windows(ids, good, 2, fresh), 2, range_bits), fresh, ids)
            give_back()


def _count_longer(batches: Iterator[pa.RecordBatch], range_bits: int) -> Iterator[pa.RecordBatch]:
    """The filters of phrases of three and more words whose pairs are all frequent."""
    for batch in batches:
        for number in range(batch.num_rows):
            row = batch.slice(number, 1)
            ids = np.frombuffer(zstandard.decompress(row.column("data")[0].as_py()), np.uint32)
            lists = [np.frombuffer(k, "<u8") for k in row.column("known").flatten().to_pylist()]
            frequent = np.sort(np.concatenate(lists))
            keys, _ = qf.permute([ids[:-1], ids[1:]])
            place = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
            good = (frequent[place] == keys) & (ids[1:] > 0) & (ids[:-1] > 0)
            for words in range(3, LONGEST + 1):
                at = _windows(ids, good, words, row.column("fresh")[0].as_py())
                yield _counted_rows(row.column("shard")[0].as_py(), words, _filters(ids, at, words, range_bits))
            give_back()


def _merge(group: pd.DataFrame, range_bits: int, min_count: int, answer: bool) -> pd.DataFrame:
    """The frequent phrases of a range, and for each shard the keys of those it has."""
    upper, lower, counts, words = qf.merge(list(group["data"]), range_bits)
    kept = counts >= min_count
    upper, lower, counts = upper[kept], lower[kept], counts[kept]
    ids = [*qf.unpermute(upper, lower, words), *[np.zeros(len(upper), np.int64)] * (4 - words)]
    found = pd.DataFrame({"kind": "phrase", "shard": 0, "words": words, **dict(zip(KEY, ids, strict=True)), "f": counts,
                          "data": None})
    if not answer or not len(upper):
        return found
    rows = []
    for shard, data in zip(group["shard"], group["data"], strict=True):
        own = qf.decode(data, range_bits)[0]
        mine = own[upper[np.minimum(np.searchsorted(upper, own), len(upper) - 1)] == own]
        if len(mine):
            rows.append(("answer", shard, words, 0, 0, 0, 0, 0, mine.astype("<u8").tobytes()))
    return pd.concat([found, pd.DataFrame(rows, columns=found.columns)]) if rows else found


def _written_by_kind(df: DataFrame) -> DataFrame:
    """The rows, in files of their own for each kind."""
    path = new_scratch(df.sparkSession)
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _merged(counted: DataFrame, range_bits: int, min_count: int, answer: bool) -> DataFrame:
    filters = counted.where("kind = 'filter'").select("range", "words", "shard", "data")
    return _written_by_kind(filters.groupBy("range", "words").applyInPandas(
        lambda group: _merge(group, range_bits, min_count, answer), MERGED))


def numbered_words(words: DataFrame) -> DataFrame:
    """The rows of a frame with ``id``: 1, 2, 3... without gaps, by partition and place there. Written."""
    def places(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch = batch.append_column("part", pa.array(np.full(batch.num_rows, part, np.int32)))
            yield batch.append_column("place", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    placed = written(words.mapInArrow(places, f"{columns}, part int, place long"))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    number = F.col("base") + F.col("place") + 1
    # An id has 32 bits in a packed phrase.
    number = F.when(number < 1 << 32, number).otherwise(F.raise_error(F.lit("more than 2**32 - 1 frequent words")).cast("long"))
    return written(placed.join(F.broadcast(bases), "part").select(number.alias("id"), *words.columns))


def count_phrases(docs: DataFrame, min_count: int = MIN_COUNT, shard_bytes: int = SHARD_BYTES,
                  min_range_bits: int = MIN_RANGE_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (id, lang, word, f), frequent phrases (words, w1..w4, f), and all words of each lang (lang, n). Written."""
    texts = docs.select("text", F.col("lang").cast("string").alias("lang"))
    shards = written(texts.mapInArrow(partial(_shards, size=shard_bytes), SHARDS))
    text_bytes = shards.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    range_bits = max(min_range_bits, (text_bytes // RANGE_BYTES).bit_length())

    listed = shards.select("shard", F.posexplode("vocabulary").alias("at", "entry")).select("shard", "at", "entry.*")
    spoken = written(listed.groupBy("lang", "word").agg(F.sum("n").alias("f")))
    totals = spoken.groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbered_words(spoken.where(F.col("f") >= min_count))

    tasks = max(shuffle_partitions(docs.sparkSession), text_bytes // TASK_BYTES)
    known = listed.join(words, ["lang", "word"]).repartition(tasks, "shard").groupBy("shard").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    pairs = _written_by_kind(shards.repartition(tasks, "shard").join(known, "shard").select("shard", "fresh", "codes", "known").mapInArrow(
        partial(_count_pairs, range_bits=range_bits), COUNTED))
    two = _merged(pairs, range_bits, min_count, True)

    answers = two.where("kind = 'answer'").repartition(tasks, "shard").groupBy("shard").agg(F.collect_list("data").alias("known"))
    streams = pairs.where("kind = 'stream'").select("shard", "fresh", "data")
    longer = _written_by_kind(streams.repartition(tasks, "shard").join(answers, "shard").mapInArrow(
        partial(_count_longer, range_bits=range_bits), COUNTED))
    more = _merged(longer, range_bits, min_count, False)

    columns = ["words", *KEY, "f"]
    phrases = written(two.where("kind = 'phrase'").select(columns).unionAll(more.where("kind = 'phrase'").select(columns)))
    release(docs.sparkSession, shards)
    return words, phrases, totals


# --- scoring --------------------------------------------------------------------------------

def _part(columns: list[str]) -> Column:
    """A phrase's words as a key of four, zeros after the last."""
    held = [F.col(c) for c in columns] + [F.lit(0).cast("long")] * (4 - len(columns))
    return F.struct(*[c.alias(k) for c, k in zip(held, KEY, strict=True)])


def _cuts() -> Column:
    """For a phrase: an array of (k, side, part) of all its cuts."""
    by_words = None
    for words in range(2, LONGEST + 1):
        parts = [F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), _part(cols).alias("part"))
                 for k in range(1, words) for side, cols in (("l", KEY[:k]), ("r", KEY[k:words]))]
        here = F.col("words") == words
        by_words = F.when(here, F.array(*parts)) if by_words is None else by_words.when(here, F.array(*parts))
    return by_words


def _inner() -> Column:
    """For a phrase: an array of the shorter phrases, of two words at least, inside it."""
    by_words = None
    for words in range(3, LONGEST + 1):
        parts = [_part(KEY[a:a + size]) for size in range(2, words) for a in range(words - size + 1)]
        here = F.col("words") == words
        by_words = F.when(here, F.array(*parts)) if by_words is None else by_words.when(here, F.array(*parts))
    return by_words


def scored_phrases(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one covers, by their lowest-scoring cut: w1..w4, words, a, l, r, score. Written."""
    singles = words.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(k) for k in KEY[1:]], "f")
    # Written: what is joined with is read from files, so AQE can split words that are part of very many phrases.
    counts = written(singles.unionAll(phrases.select(*KEY, "f")).select(F.struct(*KEY).alias("part"), F.col("f").alias("part_f")))
    cut = phrases.select(F.struct(*KEY).alias("phrase"), "words", F.col("f").alias("a"), F.explode(_cuts()).alias("cut"))
    sides = cut.select("phrase", "words", "a", "cut.*").join(counts, "part")
    sums = sides.groupBy("phrase", "words", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("part_f"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("part_f"))).alias("r"))
    # Decimals: the product may pass 64 bits.
    score = F.expr(f"cast(cast({SCORE_SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) "
                   "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    lowest = sums.withColumn("score", score).groupBy("phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = phrases.where("words > 2").select(F.explode(_inner()).alias("phrase"), F.col("f").alias("longer"))
    covers = inner.groupBy("phrase").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {COVER_PERCENT}")
    left = lowest.join(covers, "phrase", "left").where(~F.coalesce(covered, F.lit(False)))
    return written(left.select("phrase.*", "words", "a", "cut.l", "cut.r", "cut.score"))


def spelled(scored: DataFrame, words: DataFrame) -> DataFrame:
    """The scored phrases with ``lang`` and ``phrase``."""
    keyed = scored.withColumn("key", F.struct(*KEY))
    places = keyed.select("key", F.posexplode(F.slice(F.array(*KEY), F.lit(1), F.col("words"))).alias("at", "id"))
    texts = places.join(words.select("id", "lang", "word"), "id").groupBy("key").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelling"))
    return keyed.join(texts, "key").select(
        "lang", F.concat_ws(" ", F.col("spelling.word")).alias("phrase"), "a", "l", "r", "score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, **sizes: int) -> DataFrame:
    """The best ``top`` phrases of each lang: lang, rank, phrase, a, l, r, n and score."""
    words, phrases, totals = count_phrases(docs, min_count, **sizes)
    found = spelled(scored_phrases(words, phrases), words)
    # The limit is applied in every task before the rows of a lang meet.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
