"""Packing by power-of-two decomposition.

A document's ids, end included, are cut into pieces whose lengths are powers
of two: as many of ``longest`` as fit, then the binary digits of the rest,
largest first.  Every piece is a training sequence by itself, so nothing is
padded and no sequence crosses documents.  Sequences are numbered so that
those of one length form one contiguous bucket, from which batches of equal
shape can be read.

The pieces are written once; only counts by (length, partition) are summed to
number them, so tokens are shuffled only where those counts, 12 rows a
partition, are too many to broadcast.

Defined results: a null or empty text is the end id alone; repeated rows are
packed one by one; other columns aren't read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, single_threaded, small_batches, table, written
from .cuts import CutEncoder

LONGEST = 2048
END = 1
#: Counts by (length, partition) up to this number are broadcast, 24 bytes each.
BROADCAST_ROWS = 500_000
#: Rows handled at a time; bounds a worker's memory.
ROWS = 512
#: Cuts that the library encodes in one call.
JOINED = 1000


@cache
def tokens(path: str, pattern: str) -> CutEncoder:
    """One a worker; ids as the ``tokenizers`` library gives them, added tokens
    in a text included."""
    single_threaded()
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    ids = lambda e: array("i", e.ids).tobytes()
    added = [t.content for t in own.get_added_tokens_decoder().values()]
    # Tokens that begin with a space or newline, in the spelling of byte-level
    # vocabularies: each cut has one, at its start.
    first = np.array([(own.id_to_token(k) or "")[:1] in ("\u0120", "\u010a") for k in range(own.get_vocab_size())])

    def joined(cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [own.encode_batch_fast(["".join(cuts[k : k + JOINED])], add_special_tokens=False)[0].ids for k in range(0, len(cuts), JOINED)]
        flat = np.concatenate([np.array(g, np.int32) for g in got]) if got else np.zeros(0, np.int32)
        begin = np.nonzero(first[flat])[0]
        if len(begin) != len(cuts):
            raise ValueError("the vocabulary merges over a space or newline")
        return flat, np.diff(np.append(begin, len(flat)))

    return CutEncoder(pattern, lambda matches: list(map(ids, own.encode_batch_fast(matches, add_special_tokens=False))), added, lambda text: ids(own.encode(text, add_special_tokens=False)), joined)


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The piece lengths of a document of ``n`` ids."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(longest.bit_length())) if rest >> k & 1]


def pieces(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, end: int = END) -> DataFrame:
    """doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens and
    the place (part, nth) of each piece among those of its length in its partition."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokens(path, pattern), TaskContext.get().partitionId()
        count: dict[int, int] = {}
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                few = b.slice(at, ROWS)
                ids, ends = encode(few.column(1))
                ids = np.insert(ids, ends[1:], np.int32(end))
                total = np.diff(ends) + 1
                cut = [lengths(int(n), longest) for n in total]
                size = np.array([n for c in cut for n in c], np.int64)
                doc = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
                ends = np.cumsum(size)
                nth = np.empty(len(size), np.int64)
                for n in np.unique(size):
                    own = size == n
                    nth[own] = count.get(int(n), 0) + np.arange(own.sum())
                    count[int(n)] = count.get(int(n), 0) + int(own.sum())
                places = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), len(size), [None, places, pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
                columns = [few.column(0).take(pa.array(doc)), pa.array(ends - size - (np.cumsum(total) - total)[doc]), pa.array(size), packed, pa.array(total[doc]), pa.array(np.full(len(size), part, np.int32)), pa.array(nth)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "part", "nth"])
                release()

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, part int, nth long")


def pack(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, end: int = END) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every
    piece.  Ids of sequences run from 0 without a gap, short sequences first."""
    with small_batches(df.sparkSession):
        cut = written(pieces(df, path, pattern, id_col, text_col, longest, end), "pieces")
    counts = cut.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_part = counts.withColumn("before", before)
    # As many rows as there are lengths: log2(longest) + 1.
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n"))
    shorter = by_length.withColumn("shorter", F.coalesce(F.sum("n").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    base = by_part.join(shorter.select("length", "shorter"), "length").select("length", "part", (F.col("before") + F.col("shorter")).alias("base"))
    base = written(base, "sequence-bases")
    if base.count() <= BROADCAST_ROWS:  # else both sides are shuffled
        base = F.broadcast(base)
    return cut.join(base, ["length", "part"]).select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def digests(packed: DataFrame) -> DataFrame:
    """``pack``'s rows with ids_crc32 in place of the ids."""
    return packed.select(*[F.crc32("ids").alias("ids_crc32") if c == "ids" else c for c in packed.columns])


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    packed = pack(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.PATTERN)
    return digests(packed).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
