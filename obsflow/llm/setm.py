"""Collocations by relational mining of occurrences.

Texts are split into pieces and those into words.  The relation of level k holds
the occurrences of the frequent phrases of k words, sorted by piece and
position; it is stored in blocks, an id (or none) for each position.  A level
follows from the one before:

1. merge-join with itself on the piece and the adjacent position: where a
   frequent phrase begins at a position and another one at the next, both make
   up a phrase that is a word longer;
2. group and count these, in the block first, then over all blocks;
3. semi-join: only occurrences of groups of ``LEAST`` or more are kept, and
   persisted as the next relation.

Ids number the frequent phrases of a level, so a longer phrase is a pair of 32-bit
ids, its first and its last words; nothing is told apart by hashes.  A block
counts its own groups, so a frequent group is as many rows as there are blocks.
The frequent groups go to every task for the semi-join if they are counted and
found to be ``NEAR`` at most; otherwise each block's groups are joined with them,
and the answers with the blocks.

Every language is a corpus of its own; a null language is ``und``.

Defined results: a null or empty text has no words; repeated rows count again.
An empty table, or one without frequent phrases, gives no rows.  Ids and other
columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, table, written

LEAST, LONGEST, TOP = 100, 5, 2000
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
UNKNOWN = "und"
#: Bytes of text of a block (one longer text is a block); bounds a worker's memory.
BLOCK = 16 << 20
#: Frequent groups up to this number, and bytes of their words, go to every task.
NEAR, NEAR_BYTES = 1 << 21, 32 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)], _KIND[list(PIECE_ENDS)] = 1, 2


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(a, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view(np.uint32).reshape(n)


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words and, for each position, a word's number from 1; a 0
    stands between pieces."""
    kind_of = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
    inside = np.append(_KIND[kind_of] == 0, False)
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if not len(begin):
        return pa.array([], pa.binary()), np.zeros(0, np.uint32)
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    letters = kind_of[inside[:-1]]
    coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    piece = np.cumsum(_KIND[kind_of] == 2, dtype=np.int32)[begin]
    code = coded.indices.to_numpy().astype(np.uint32) + np.uint32(1)
    return coded.dictionary, np.insert(code, np.nonzero(np.diff(piece))[0] + 1, np.uint32(0))


def blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """block, lang, the words of a block with their counts, n positions and codes."""

    def one(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        from uuid import uuid4

        words, code = words_of(texts)
        count = np.bincount(code, minlength=len(words) + 1)[1:]
        lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.StructArray.from_arrays([words.cast(pa.string()), pa.array(np.arange(1, len(words) + 1)), pa.array(count)], names=["word", "code", "n"]))
        pa.default_memory_pool().release_unused()
        return pa.RecordBatch.from_arrays([pa.array([uuid4().int >> 65]), pa.array([lang]), lists, pa.array([len(code)]), pa.array([_pack(code)])], names=["block", "lang", "words", "n", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        total: dict[str, int] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                held.setdefault(lang, []).append(data)
                total[lang] = total.get(lang, 0) + len(data)
                if sum(total.values()) >= size:  # the largest language goes
                    most = max(total, key=total.get)
                    yield one(most, held.pop(most))
                    del total[most]
        for lang, texts in held.items():
            yield one(lang, texts)

    return rows.mapInArrow(run, "block long, lang string, words array<struct<word:string,code:long,n:long>>, n long, codes binary")


def numbered(groups: DataFrame, label: str) -> DataFrame:
    """Adds ids from 1 without a gap; only counts by partition are summed."""
    raw = written(groups.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    counts = raw.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a partition
    base = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return raw.join(F.broadcast(base), "_part").withColumn("id", F.col("_base") + F.col("_nth") + 1).drop("_part", "_nth", "_base")


def kept_near(relation: DataFrame, frequent: DataFrame, words: bool) -> DataFrame:
    """The relation with the positions of the frequent groups alone, as their ids.
    frequent: lang and word, or local; and id; few enough for every task."""
    shared = relation.sparkSession.sparkContext.broadcast(frequent.toArrow().combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = shared.value
        if words:
            by_lang = {lang: got.filter(pc.equal(got["lang"], lang)) for lang in pc.unique(got["lang"]).to_pylist()}
        else:
            sort = np.argsort(got["local"].to_numpy())
            local, ids = got["local"].to_numpy()[sort], got["id"].to_numpy()[sort]
        for b in batches:
            for k in range(b.num_rows):
                code = _unpack(b.column("codes")[k].as_py(), b.column("n")[k].as_py())
                if words:
                    own, part = b.column("words")[k].values, by_lang.get(b.column("lang")[k].as_py(), got.slice(0, 0))
                    at = pc.fill_null(pc.index_in(own.field("word"), value_set=part["word"]), -1).to_numpy()
                    id_of = np.append(0, np.where(at >= 0, np.append(part["id"].to_numpy(), 0)[at], 0))
                    new = id_of[code]  # codes number the words from 1
                else:
                    new = _looked_up(_pairs(code), local, ids)
                yield pa.RecordBatch.from_arrays([b.column("block").slice(k, 1), b.column("n").slice(k, 1), pa.array([_pack(new)])], names=["block", "n", "codes"])
                pa.default_memory_pool().release_unused()

    columns = ["block", "n", "codes", *(["lang", "words"] if words else [])]
    return relation.select(*columns).mapInArrow(run, "block long, n long, codes binary")


def kept_far(relation: DataFrame, asked: DataFrame, frequent: DataFrame, on: list[str], paired: bool) -> DataFrame:
    """The same for any number of frequent groups.

    asked: block, ``on`` and ``local`` (what the block's positions hold, or a pair
    of ids) of each group of each block.
    """
    answers = asked.join(frequent.select(*on, "id"), on).groupBy("block").agg(F.collect_list(F.struct("local", "id")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                code, got = _unpack(b.column(2)[k].as_py(), b.column(1)[k].as_py()), b.column(3)[k].values
                local, ids = got.field("local").to_numpy(), got.field("id").to_numpy()
                sort = np.argsort(local)
                new = _looked_up(_pairs(code) if paired else code.astype(np.int64), local[sort], ids[sort])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), b.column(1).slice(k, 1), pa.array([_pack(new)])], names=["block", "n", "codes"])
                pa.default_memory_pool().release_unused()

    return relation.select("block", "n", "codes").join(answers, "block").mapInArrow(run, "block long, n long, codes binary")


def _looked_up(held: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of each number that is a key, else 0; keys ascend."""
    if not len(keys):
        return np.zeros(len(held), np.uint32)
    at = np.minimum(np.searchsorted(keys, held), len(keys) - 1)
    return np.where((keys[at] == held) & (held > 0), ids[at], 0)


def _pairs(code: np.ndarray) -> np.ndarray:
    """For each position its id and the next one's as one number; 0 without either."""
    both = np.zeros(len(code), np.int64)
    one, two = code[:-1].astype(np.int64), code[1:].astype(np.int64)
    both[:-1] = np.where((one > 0) & (two > 0), one << 32 | two, 0)
    return both


def joined(relation: DataFrame) -> DataFrame:
    """block, local (a pair of ids at adjacent positions) and n of every pair of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                pair = _pairs(_unpack(b.column(2)[k].as_py(), b.column(1)[k].as_py()))
                pair, n = np.unique(pair[pair > 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), b.column(0)[k].as_py(), np.int64)), pa.array(pair), pa.array(n)], names=["block", "local", "n"])
                pa.default_memory_pool().release_unused()

    return relation.select("block", "n", "codes").mapInArrow(run, "block long, local long, n long")


def mine(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, block: int = BLOCK, near: int = NEAR) -> tuple[list[DataFrame], DataFrame]:
    """(levels, totals): for each length the frequent phrases, lang, id, a, words, and
    the counts of their first (``first_n``) and last words (``last_n``) by length,
    with the ids of the phrases one word shorter; and lang and n of all words."""
    rows = df.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    relation = written(blocks(rows, block), "word-blocks")
    asked = relation.select("block", "lang", F.explode("words").alias("w")).select("block", "lang", "w.word", F.col("w.code").alias("local"), "w.n")
    counts = written(asked.groupBy("lang", "word").agg(F.sum("n").alias("a")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = numbered(counts.filter(F.col("a") >= least), "frequent-words")
    one = F.array("a")
    levels = [written(frequent.select("lang", "id", "a", F.array("word").alias("words"), one.alias("first_n"), one.alias("last_n")), "phrases")]
    size = frequent.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
    few = size["n"] <= near and size["bytes"] <= NEAR_BYTES
    now = written(kept_near(relation, frequent.select("lang", "word", "id"), True) if few else kept_far(relation, asked, frequent, ["lang", "word"], False), "occurrences")
    dropped(relation)
    for k in range(2, longest + 1):
        # Blocks have counted their own; no group has more rows than there are blocks.
        summed = joined(now).repartition("local").groupBy("local").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
        frequent = numbered(summed, "frequent-groups")
        levels.append(written(_described(frequent, levels[-1]), "phrases"))
        if k < longest:
            few = frequent.count() <= near
            after = written(kept_near(now, frequent.select("local", "id"), False) if few else kept_far(now, joined(now), frequent, ["local"], True), "occurrences")
            dropped(now)
            now = after
    dropped(now)
    return levels, totals


def _described(frequent: DataFrame, shorter: DataFrame) -> DataFrame:
    """Pairs of ids as phrases, by the two phrases that they are made of."""
    f = frequent.select("id", "a", F.shiftrightunsigned("local", 32).alias("first_id"), F.col("local").bitwiseAND(F.lit((1 << 32) - 1)).alias("last_id"))
    first = shorter.select(F.col("id").alias("first_id"), "lang", F.col("words").alias("_words"), F.col("first_n").alias("_first"))
    last = shorter.select(F.col("id").alias("last_id"), F.slice("words", -1, 1).alias("_word"), F.col("last_n").alias("_last"))
    whole = f.join(first, "first_id").join(last, "last_id")
    return whole.select("lang", "id", "a", F.concat("_words", "_word").alias("words"), F.concat("_first", F.array("a")).alias("first_n"), F.concat("_last", F.array("a")).alias("last_n"), "first_id", "last_id")


def scored(level: DataFrame, length: int, totals: DataFrame) -> DataFrame:
    """lang, id, phrase, a, l, r, n and score of the phrases of one length."""
    wide = lambda c: c.cast("decimal(18,0)")
    cuts: list[Column] = []
    for k in range(1, length):
        left, right = F.col("first_n")[k - 1], F.col("last_n")[length - k - 1]
        # Products of two counts have at most 36 digits, so they are exact.
        of, by = wide(F.col("a")) * wide(F.col("n")) * F.lit(1000).cast("decimal(4,0)"), wide(left) * wide(right)
        score = F.call_function("div", of, by).cast("long")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    phrases = level.join(totals, "lang").withColumn("_cut", F.array_min(F.array(*cuts)))
    return phrases.select("lang", "id", F.array_join("words", " ").alias("phrase"), "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, block: int = BLOCK, near: int = NEAR) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases that
    no longer frequent phrase of equal count holds.

    A phrase in a longer one of its count is in one a word longer of its count,
    so the next level alone is asked.
    """
    levels, totals = mine(df, lang_col, text_col, least, longest, block, near)
    parts = []
    for k in range(2, longest + 1):
        part = scored(levels[k - 1], k, totals)
        if k < longest:
            longer = levels[k]
            held = longer.filter(F.col("a") == F.col("first_n")[k - 1]).select(F.col("first_id").alias("id")).unionByName(longer.filter(F.col("a") == F.col("last_n")[k - 1]).select(F.col("last_id").alias("id")))
            part = part.join(held, "id", "left_anti")
        parts.append(part.drop("id"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same by grouping all phrases of each length."""
    phrase = lambda k: f"SELECT lang, {k} AS k, unnest(list_transform(range(1, greatest(len(w) - {k - 2}, 1)), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) AS phrase FROM p"
    return f"""WITH s AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM s), total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM ({' UNION ALL '.join(phrase(k) for k in range(1, LONGEST + 1))}) GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
held AS (SELECT DISTINCT lang, array_to_string(w[i : i + j - 1], ' ') AS phrase, a FROM c, unnest(range(2, k)) t(j), unnest(range(1, k - j + 2)) u(i)),
cut AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, i, 1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a) AS score FROM c JOIN total USING (lang), unnest(range(1, c.k)) t(i) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : i], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[i + 1 : c.k], ' ')
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = c.lang AND h.phrase = c.phrase AND h.a >= c.a)),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM best QUALIFY rank <= {TOP}"""
