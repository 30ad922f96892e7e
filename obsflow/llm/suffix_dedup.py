"""Removal of byte strings that stand earlier in the corpus.

A byte goes if a string of ``least`` bytes that covers it also starts earlier
(smaller id, or same text and earlier start).  Common prefixes come from
suffix order: the strings of a bucket are joined, their suffixes sorted, and
intervals of the Burrows-Wheeler transform are extended backward, breadth
first.  An interval that ends at a place without a value gives that place its
common-prefix length, the level; so lengths are found by increasing value and
the search stops at ``least``.  Suffixes between which no length was found
share ``least`` bytes at least.

What is alike meets in one bucket without moving the corpus: every window of
``least`` bytes has an anchor, its leftmost gram of the smallest hash, which
depends on the window's bytes alone.  A run of windows of one anchor is a
string, and equal windows lie in strings of equal gram.  Strings whose gram
stands nowhere else are dropped before any text moves.  Equal strings become
one, the first, in a task before the shuffle and again after it; the others go
whole.  Only different strings of one gram are fetched, cut to the windows whose
halves stand twice in their bucket, and compared by suffix order.  A gram with more than ``MOST`` different strings is too hot for one
bucket: its strings are cut into single windows, whose hashes are their keys.

Grams and strings are told apart by 64 bits each, 128 together.

Defined results: a null text is empty; a text under ``least`` bytes loses
nothing.  Null ids come before all others.  Rows of one id are texts of
their own, in the order of their texts' hashes, and equal rows one after the
other.  An empty table gives no rows.  Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, table, written

LEAST = 100
#: Bytes of an anchor's gram.
GRAM = 16
#: Bytes of text handled at a time; longer texts come in parts that overlap.
BLOCK = 4 << 20
#: Bytes of strings for which there is a bucket, and different strings of a gram
#: that one bucket takes; they bound a worker's memory.
BUCKET_BYTES, MOST = 1 << 20, 20_000

STRINGS = "key long, digest long, row long, start long, size int, again boolean"


def _gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes from each place on."""
    h = (buf.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    size, factor = 1, 0x9E3779B97F4A7C15
    while size < k:
        step = min(size, k - size)
        longer = h[:-step] * np.uint64(factor)
        longer += h[step:]
        h, size = longer, size + step
        factor = (factor * 0xC2B2AE3D27D4EB4F | 1) & (1 << 64) - 1
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def runs(buf: np.ndarray, ends: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, last) of each run of windows with one anchor, of texts that
    stand one after the other in ``buf`` and end at ``ends``."""
    none = np.zeros(0, np.int64)
    if len(buf) < least:
        return none.astype(np.uint64), none, none
    hashes = _gram_hashes(buf, gram)
    lowest, size = hashes, 1
    while size < least - gram + 1:
        step = min(size, least - gram + 1 - size)
        lowest, size = np.minimum(lowest[:-step], lowest[step:]), size + step
    begin = np.concatenate([[0], ends[:-1]])
    whole = ends - begin >= least
    change = np.zeros(len(buf) + 1, np.int64)
    change[begin[whole]] += 1
    change[ends[whole] - least + 1] -= 1
    inside = np.cumsum(change)[: len(lowest)] > 0
    # A run ends where the text ends, the smallest hash changes, or its place does.
    new = np.ones(len(lowest), bool)
    new[1:] = (lowest[1:] != lowest[:-1]) | (hashes[: len(lowest) - 1] == lowest[1:])
    new[begin[whole]] = True
    at = np.nonzero(inside)[0]
    first = np.nonzero(new[at])[0]
    last = np.append(first[1:], len(at)) - 1
    return lowest[at[first]], at[first], at[last]


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, ends, rows and offsets of parts of texts, BLOCK bytes at a time; the
    parts of one text overlap by least - 1 bytes."""
    rows, offsets, parts, held = [], [], [], 0
    for b in batches:
        for row, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            data = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
            for at in range(0, max(1, len(data) - least + 1), BLOCK):
                part = data[at : at + BLOCK + least - 1]
                rows.append(row), offsets.append(at), parts.append(part)
                held += len(part)
                if held >= BLOCK:
                    yield _block(rows, offsets, parts)
                    rows, offsets, parts, held = [], [], [], 0
    if parts:
        yield _block(rows, offsets, parts)


def _block(rows: list, offsets: list, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]), np.array(rows, np.int64), np.array(offsets, np.int64)


def _digests(buf: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    data = memoryview(buf)
    return np.fromiter((xxh3_64_intdigest(data[i:j]) for i, j in zip(first.tolist(), end.tolist(), strict=True)), np.uint64, len(first))


def strings(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """The strings of all texts (row, text); ``again`` marks those that an earlier
    one of the same block equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buf, ends, rows, offsets in _blocks(batches, least):
            key, first, last = runs(buf, ends, least, gram)
            text = np.searchsorted(ends, first, side="right")
            start = first - np.concatenate([[0], ends])[text] + offsets[text]
            digest = _digests(buf, first, last + least)
            order = np.lexsort((start, rows[text], digest, key))
            key, digest = key[order], digest[order]
            again = np.zeros(len(key), bool)
            again[1:] = (key[1:] == key[:-1]) & (digest[1:] == digest[:-1])
            columns = [key.view(np.int64), digest.view(np.int64), rows[text][order], start[order], (last + least - first)[order].astype(np.int32), again]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[c.split()[0] for c in STRINGS.split(", ")])
            pa.default_memory_pool().release_unused()

    return texts.select("row", "text").mapInArrow(run, STRINGS)


def settled(found: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(marks, unlike, tables): strings with an equal one before them, row, start and
    size; different strings whose key others have too, with ``n`` of them; and
    what both are read from."""
    found = written(found, "strings", dictionary=False)
    own = found.filter("!again").drop("again")
    shared = own.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    met = written(own.join(shared, "key"), "shared-strings", dictionary=False)
    nth = F.row_number().over(Window.partitionBy("key", "digest").orderBy("row", "start"))
    ranked = written(met.withColumn("nth", nth), "ranked-strings", dictionary=False)
    dropped(met)
    marks = found.filter("again").select("row", "start", "size").unionByName(ranked.filter("nth > 1").select("row", "start", "size"))
    different = ranked.filter("nth = 1").drop("nth")
    several = different.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    unlike = written(different.join(several, "key"), "unlike-strings", dictionary=False)
    return marks, unlike, [found, ranked, unlike]


def fetched(texts: DataFrame, unlike: DataFrame) -> DataFrame:
    """key, row, start and the bytes of each string."""
    asked = unlike.groupBy("row").agg(F.collect_list(F.struct("key", "start", "size")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text, few in zip(b.column(0), b.column(1), b.column(2), strict=True):
                data, few = memoryview(text.as_buffer()), few.values
                start, size = few.field("start").to_numpy(), few.field("size").to_numpy()
                cut = [bytes(data[i : i + n]) for i, n in zip(start.tolist(), size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([few.field("key"), pa.array([row.as_py()] * len(cut), pa.int64()), few.field("start"), pa.array(cut, pa.binary())], names=["key", "row", "start", "data"])

    return texts.select("row", "text").join(asked, "row").mapInArrow(run, "key long, row long, start long, data binary")


def windows(fetched_strings: DataFrame, least: int) -> DataFrame:
    """The single windows of strings, as strings of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for b in batches:
            for row, start, data in zip(b.column("row").to_pylist(), b.column("start").to_pylist(), b.column("data").to_pylist(), strict=True):
                n = len(data) - least + 1
                each = [data[i : i + least] for i in range(n)]
                key = np.fromiter(map(xxh64_intdigest, each), np.uint64, n).view(np.int64)
                digest = _digests(np.frombuffer(data, np.uint8), np.arange(n), np.arange(n) + least).view(np.int64)
                columns = [pa.array(key), pa.array(digest), pa.array([row] * n, pa.int64()), pa.array(start + np.arange(n)), pa.array(np.full(n, least, np.int32)), pa.array(np.zeros(n, bool))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in STRINGS.split(", ")])

    return fetched_strings.mapInArrow(run, STRINGS)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of strings, each ended by a 0, in order of their first
    ``depth`` symbols at least; equal suffixes stand in order of their places, and
    what is alike so far in any order."""
    n, packed = len(symbols), 7
    key, going = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(packed):  # seven symbols of nine bits, none after a string's end
        here = np.zeros(n, np.int64)
        here[: n - k] = symbols[k:]
        going &= here > 0
        key <<= 9
        key |= here * going
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank, h = np.empty(n, np.int64), packed
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ends = np.nonzero(symbols == 0)[0]
    end = np.repeat(ends, np.diff(ends, prepend=-1))
    tied = np.nonzero(~new | np.append(~new[1:], False))[0]
    while h < depth and len(tied):
        some = order[tied]
        then = some + h
        # What has ended within h symbols is told apart by its place.
        pair = rank[some] * n + np.where(then > end[some], some, rank[np.minimum(then, n - 1)])
        sort = np.argsort(pair)
        some, pair = some[sort], pair[sort]
        order[tied] = some
        new = np.append(True, pair[1:] != pair[:-1])
        rank[some] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~new | np.append(~new[1:], False)]
        h *= 2
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each place of the order, the length that its suffix shares with the one
    before; -1 where that is ``least`` or more.

    An interval holds the suffixes that begin with one word; extended by the
    symbols before them it gives the intervals of words one longer.  The end of
    an interval of words of length l + 1 bounds a common prefix of length l,
    unless a shorter one was found there, and only such intervals go on.
    Intervals of one suffix need no sort.
    """
    n = len(order)
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    # The transform, and where its suffixes stand, in one number.
    before = symbols[order - 1].astype(np.int64) << bits | at[order - 1]
    length = np.full(n + 1, -1, np.int64)
    length[0] = length[n] = 0
    ends = np.nonzero(symbols[order] == 0)[0]  # every string's end is unlike all others
    length[ends] = length[ends + 1] = 0
    low, high = np.zeros(1, np.int64), np.full(1, n - 1)
    for level in range(least):
        several = high > low
        alone = before[low[~several]]
        alone = alone[alone > mask] & mask
        low, size = low[several], (high - low + 1)[several]
        nth = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(nth)) + np.repeat(low - np.cumsum(size) + size, size)
        to = np.sort(nth << bits + 9 | before[place])
        word = to >> bits
        last = np.nonzero(np.append(word[1:] != word[:-1], np.ones(min(1, len(word)), bool)))[0]
        first = np.append(0, last[:-1] + 1)[: len(last)]
        some = word[first] & 511 > 0
        low, high = np.append(to[first[some]] & mask, alone), np.append(to[last[some]] & mask, alone)
        fresh = length[high + 1] < 0
        low, high = low[fresh], high[fresh]
        length[high + 1] = level
        if not level:  # words that are an end and nothing else
            low, high = np.append(low, ends), np.append(high, ends)
        if not len(low):
            break
    return length[:n]


def promising(data: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, last) of runs of windows that may stand twice: each gram of
    half their length that they hold does, by its hash."""
    size = np.array([len(d) for d in data], np.int64)
    half = least // 2
    hashes = _gram_hashes(np.frombuffer(b"".join(data), np.uint8), half)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    once = np.ones(len(hashes), np.int64)
    once[order[1:][same]] = once[order[:-1][same]] = 0
    seen = np.concatenate([[0], np.cumsum(once)])
    begin = np.cumsum(size) - size
    n = size - least + 1
    string = np.repeat(np.arange(len(size)), n)
    place = np.arange(len(string)) + np.repeat(begin - np.cumsum(n) + n, n)
    there = np.nonzero(seen[place + least - half + 1] == seen[place])[0]
    string, place = string[there], place[there] - begin[string[there]]
    first = np.nonzero(np.append(np.ones(min(1, len(there)), bool), (np.diff(there) > 1) | (np.diff(string) > 0)))[0]
    return string[first], place[first], place[np.append(first[1:], len(there))[: len(first)] - 1]


def repeats(data: list[bytes], row: np.ndarray, start: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, last) of runs of windows of strings that start at (row,
    start), each window equal to one that starts earlier."""
    if not data:
        return (np.zeros(0, np.int64),) * 3
    size = np.array([len(d) for d in data], np.int64)
    ends = np.cumsum(size + 1)
    symbols = np.frombuffer(b"\0".join(data) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    symbols[ends - 1] = 0
    order = suffix_order(symbols, least)
    group = np.cumsum(common_prefixes(symbols, order, least) >= 0)
    string = np.searchsorted(ends, order, side="right")
    place = order - (ends - size - 1)[string]
    whole = place + least <= size[string]
    group, string, place = group[whole], string[whole], place[whole]
    sort = np.lexsort((start[string] + place, row[string], group))
    group, string, place = group[sort], string[sort], place[sort]
    later = np.append(False, group[1:] == group[:-1]) if len(group) else np.zeros(0, bool)
    string, place = string[later], place[later]
    sort = np.lexsort((place, string))
    string, place = string[sort], place[sort]
    new = np.ones(len(string), bool)
    new[1:] = (string[1:] != string[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(string)) - 1 if len(first) else first
    return string[first], place[first], place[last]


def compared(strings_of_keys: DataFrame, least: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row, start and size of what stands earlier in another string of the key."""
    total = strings_of_keys.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / bucket_bytes))

    def run(got: pa.Table) -> pa.Table:
        data, row, start = got["data"].to_pylist(), got["row"].to_numpy(), got["start"].to_numpy()
        string, first, last = promising(data, least)
        data = [data[k][i : j + least] for k, i, j in zip(string.tolist(), first.tolist(), last.tolist(), strict=True)]
        row, start = row[string], start[string] + first
        string, first, last = repeats(data, row, start, least)
        out = pa.table({"row": row[string], "start": start[string] + first, "size": (last - first + least).astype(np.int32)})
        pa.default_memory_pool().release_unused()
        return out

    dealt = strings_of_keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "row long, start long, size int")


def marks(texts: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """row, start and size of stretches to remove; they overlap.  texts: row, text;
    rows of smaller numbers are earlier."""
    if least < 2:
        raise ValueError("strings of two bytes at least are compared")
    out, unlike, tables = settled(strings(texts, least, min(GRAM, least // 2)))
    hot = unlike.filter(F.col("n") > most)
    if not hot.isEmpty():
        again, collided, more = settled(windows(fetched(texts, hot), least))
        out, unlike, tables = out.unionByName(again), unlike.filter(F.col("n") <= most).unionByName(collided), tables + more
    few = written(fetched(texts, unlike), "fetched-strings")
    out = written(out.unionByName(compared(few, least)), "repeat-marks")
    for t in [*tables, few]:
        dropped(t)
    return out


def numbered(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id and text; rows number the texts by id.  Unique whole-number ids
    are their own numbers, other tables are sorted and written once."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if rows.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        n = rows.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
        if n["n"] == n["ids"]:
            return rows.withColumn("row", F.col("doc_id").cast("long"))
    ordered = rows.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    return written(ordered.withColumn("row", F.monotonically_increasing_id()), "numbered-texts")


def merged(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs that the stretches cover."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], (start + size)[order]
    reach = np.maximum.accumulate(end)
    first = np.nonzero(np.append(True, start[1:] > reach[:-1]))[0]
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, spans (array of removed start and end) and kept (the bytes
    that are left, which may cut characters) of every row."""
    texts = numbered(df, id_col, text_col)
    spans = marks(texts, least, most).groupBy("row").agg(F.collect_list(F.struct("start", "size")).alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept = [], []
            for text, few in zip(b.column("text"), b.column("marks"), strict=True):
                data = memoryview(text.as_buffer())
                if not few.is_valid:
                    spans.append([])
                    kept.append(bytes(data))
                    continue
                begin, end = merged(few.values.field("start").to_numpy(), few.values.field("size").to_numpy())
                spans.append([{"start": i, "end": j} for i, j in zip(begin.tolist(), end.tolist(), strict=True)])
                kept.append(b"".join(data[i:j] for i, j in zip([0, *end.tolist()], [*begin.tolist(), len(data)], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pc.binary_length(b.column("text")).cast(pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.join(spans, "row", "left").select("doc_id", "text", "marks").mapInArrow(run, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op11_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The same by grouping every window of LEAST bytes.
ORACLE = f"""WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, list_transform(range(octet_length(b) - {LEAST} + 1), lambda i: hash(b[i + 1 : i + {LEAST}])) AS h FROM t WHERE octet_length(b) >= {LEAST}),
w AS (SELECT doc_id, unnest(h) AS h, generate_subscripts(h, 1) - 1 AS i FROM h), f AS (SELECT h, min((doc_id, i)) AS first FROM w GROUP BY h),
r AS (SELECT doc_id, i, coalesce(i > lag(i) OVER o + {LEAST}, true) AS fresh FROM w JOIN f USING (h) WHERE (doc_id, i) <> first WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM r),
s AS (SELECT doc_id, g, min(i) AS i, max(i) + {LEAST} AS j FROM g GROUP BY ALL),
c AS (SELECT doc_id, i, j, coalesce(lag(j) OVER (PARTITION BY doc_id ORDER BY i), 0) AS before FROM s),
d AS (SELECT doc_id, sum(j - i)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(hex(b[before + 1 : i]), '' ORDER BY i) || hex(any_value(b)[max(j) + 1 : octet_length(any_value(b))]) AS kept
  FROM c JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256 FROM t LEFT JOIN d USING (doc_id)"""
