"""Language-model scoring by deleted interpolation.

The model is a bigram of words; the context of a text's first word is its
start.  The maximum-likelihood estimates of

    bigram    c(h, w) / c(h)
    unigram   c(w) / N
    uniform   1 / (V + 1)

are mixed with weights that depend on the bucket of c(h) (its binary order of
magnitude).  The weights are learned by expectation-maximisation on held-out
counts: those of ``DEV`` of the training rows, against the counts of the rest.
Then the counts of all training rows are used.  Every word and every pair of
words counts; no vocabulary is cut off.

Texts are tokenised once, in batches of at most ``BYTES``.  A batch asks for the
counts of its distinct words and pairs: their sorted 64-bit keys, with what the
batch itself adds to the counts, go in blocks to the bucket of their key range.
A bucket sums what all batches bring for a key and answers each block with the
totals alone, in the block's order.  So what is shuffled is one key for each
distinct pair of a batch, whatever is frequent is met once a batch, and no
count goes through the driver.  The number of buckets grows with the text, so
that a bucket stays small.

A batch meets its answers in a co-group of its own, once for the weights and once
for the scores.  So no task, row or file needs memory for more than a few batches,
however many of them are in a partition.

Words are told apart by their 64-bit XXH64, pairs by a mix of both words' keys.

Defined results: a null or empty text is one end token.  One row comes back for
every row: rows with equal ids count as a text each, rows with a null id are
scored, but neither learned from nor held out.  Without training rows every
token has probability 1.  Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, dropped, id_mod, id_mod_py, small_batches, table, written

#: Remainders of crc32(id) modulo FOLDS: held out from training, and held out
#: within training for the weights.
FOLDS, HELD_OUT, DEV = 10, 0, 1
#: Rows and bytes of text of a batch at most (one longer text is a batch); they
#: bound a worker's memory.
ROWS, BYTES = 2048, 4 << 20
#: Batches of texts that Python gets at a time, where it doesn't get them one by one.
TOGETHER = 8
#: Bytes of text for which there is a bucket of counts.
BUCKET_BYTES = 16 << 20
ROUNDS = 30
#: Held-out events whose estimates agree to this part of a binary order of
#: magnitude are summed before the weights are learned.
FINE = 4


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


#: The keys of the end token and of a text's start: of white space, which no word has.
def _end() -> np.uint64:
    return _hash([b"\n"])[0]


def _start() -> np.uint64:
    return _hash([b"\t"])[0]


@dataclass
class Tokens:
    """Tokens of a batch of texts, each text's words and its end."""

    keys: np.ndarray  # of the distinct tokens, ascending, unsigned
    code: np.ndarray  # of each token, into keys
    ends: np.ndarray  # of each text's tokens, with a 0 in front

    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context, word) codes of the distinct pairs, the start being context
        len(keys); each token's place among them; and their keys."""
        context = np.empty_like(self.code)
        context[1:] = self.code[:-1]
        context[self.ends[:-1]] = len(self.keys)
        one, at = np.unique(context * len(self.keys) + self.code, return_inverse=True)
        h, w = one // len(self.keys), one % len(self.keys)
        key = np.append(self.keys, _start())[h] * np.uint64(0x9E3779B97F4A7C15) + self.keys[w]
        key = (key ^ key >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        return h, w, at, key ^ key >> np.uint64(29)


def tokens(texts: pa.Array) -> Tokens:
    spaced = pc.fill_null(texts.cast(pa.large_string()), "")
    for c in WS_CHARS[1:]:
        spaced = pc.replace_substring(spaced, c, " ")
    # ascii_lower comes after, since it is wrong on slices of arrays.
    parts = pc.split_pattern(pc.ascii_lower(spaced), " ")
    coded = parts.flatten().dictionary_encode()
    words = [w.encode("utf-8", "surrogatepass") for w in coded.dictionary.to_numpy(zero_copy_only=False)]
    begin = parts.offsets.to_numpy()
    begin = begin - begin[0]
    code = np.insert(coded.indices.to_numpy().astype(np.int64), begin[1:], len(words))
    size = np.diff(begin) + 1
    if b"" in words:  # what stands between two white spaces and at the ends
        there = code != words.index(b"")
        size = np.add.reduceat(there, np.cumsum(size) - size) if len(size) else size
        code = code[there]
    keys = np.append(_hash(words), _end())
    used = np.bincount(code, minlength=len(keys)) > 0
    keys, inverse = np.unique(np.where(used, keys, _end()), return_inverse=True)
    return Tokens(keys, inverse[code], np.concatenate([[0], np.cumsum(size)]))


def _pack(a: np.ndarray) -> bytes:
    """The array's bytes by significance, compressed: what is alike comes together."""
    raw = np.ascontiguousarray(a)
    return pa.compress(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(data, decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).reshape(n)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Of ascending keys the differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n, np.uint64), dtype=np.uint64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id, text) of at most ROWS rows and, but for one row, BYTES; what
    is left of one goes with the next."""
    held, rows, size = [], 0, 0
    for whole in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(), dtype=np.int64)])
        at = 0
        while at < whole.num_rows:
            to = min(at + ROWS - rows, int(np.searchsorted(ends, ends[at] + BYTES - size, side="right")) - 1)
            to = max(to, at if held else at + 1)
            if to > at:
                held.append(whole.slice(at, to - at))
                rows, size = rows + to - at, size + int(ends[to] - ends[at])
            if to < whole.num_rows:
                yield pa.concat_batches(held)
                held, rows, size = [], 0, 0
            at = to
    if held:
        yield pa.concat_batches(held)


def batched(rows: DataFrame) -> DataFrame:
    """A row a batch of texts: its name, ids, and its tokens packed."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        for b in _slices(batches):
            ids, t = b.column(0), tokens(b.column(1))
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            packed = [pa.array([x]) for x in (_pack(t.ends), _pack(t.code.astype(np.uint32)), _pack_keys(t.keys))]
            yield pa.RecordBatch.from_arrays([pa.array([uuid4().hex]), lists, *packed, pa.array([len(t.code)]), pa.array([len(t.keys)])], names=["batch", "ids", "ends", "codes", "keys", "n_tokens", "n_keys"])
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"batch string, ids array<{id_type}>, ends binary, codes binary, keys binary, n_tokens long, n_keys long")


def _tokens_of(b: pa.RecordBatch | pa.Table, row: int) -> tuple[pa.Array, Tokens]:
    value = lambda name: b.column(name)[row].as_py()
    ids = b.column("ids")[row].values
    return ids, Tokens(_unpack_keys(value("keys"), value("n_keys")), _unpack(value("codes"), value("n_tokens"), np.uint32).astype(np.int64), _unpack(value("ends"), len(ids) + 1, np.int64))


ASKED = "batch string, bucket int, n_words int, n_pairs int, words binary, words_n binary, words_dev binary, pairs binary, pairs_n binary, pairs_dev binary"


def asked(texts: DataFrame, buckets: int) -> DataFrame:
    """For each batch and bucket the keys of distinct words and pairs, ascending,
    with the batch's counts in training rows and in DEV rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
        for b, row in ((b, row) for b in batches for row in range(b.num_rows)):
            ids, t = _tokens_of(b, row)
            fold = np.array([-1 if i is None else id_mod_py(i, FOLDS) for i in ids.to_pylist()], np.int64)
            of = fold[t.text()]
            train, dev = of > HELD_OUT, of == DEV
            h, w, at, key = t.pairs()
            order = np.argsort(key)
            count = lambda code, n, which: np.bincount(code, which, n).astype(np.int64)
            parts = [
                (t.keys, count(t.code, len(t.keys), train), count(t.code, len(t.keys), dev)),
                (key[order], count(at, len(key), train)[order], count(at, len(key), dev)[order]),
            ]
            # A text's start is counted with the pairs, by its own key.
            place = int(np.searchsorted(parts[1][0], _start()))
            parts[1] = tuple(np.insert(a, place, v) for a, v in zip(parts[1], (_start(), (fold > HELD_OUT).sum(), (fold == DEV).sum()), strict=True))
            cut = [np.concatenate([[0], np.searchsorted(k, bounds), [len(k)]]) for k, _, _ in parts]
            blocks = [[pack(a[i:j]) for i, j in zip(c[:-1], c[1:], strict=True)] for p, c in zip(parts, cut, strict=True) for a, pack in zip(p, (_pack_keys, _pack, _pack), strict=True)]
            name = b.column("batch")[row].as_py()
            columns = [pa.array([name] * buckets), pa.array(range(buckets), pa.int32()), *[pa.array(np.diff(c).astype(np.int32)) for c in cut], *[pa.array(x, pa.binary()) for x in blocks]]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ASKED.split(", ")])
            pa.default_memory_pool().release_unused()

    return texts.select("batch", "ids", "ends", "codes", "keys", "n_tokens", "n_keys").mapInArrow(run, ASKED)


TOTALS = "batch string, bucket int, n_words int, n_pairs int, words_n binary, words_dev binary, pairs_n binary, pairs_dev binary, tokens long, tokens_dev long, types long"


def _sum_bucket(got: pa.Table) -> pa.Table:
    """The totals of every key of a bucket, block by block."""
    out = {"batch": got["batch"], "bucket": got["bucket"], "n_words": got["n_words"], "n_pairs": got["n_pairs"]}
    rows = got.num_rows
    for kind in ("words", "pairs"):
        size = got[f"n_{kind}"].to_numpy()
        keys = np.concatenate([_unpack_keys(x.as_py(), int(n)) for x, n in zip(got[kind], size, strict=True)])
        one, at = np.unique(keys, return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(size)])
        for what in ("n", "dev"):
            own = np.concatenate([_unpack(x.as_py(), int(n), np.int64) for x, n in zip(got[f"{kind}_{what}"], size, strict=True)])
            total = np.bincount(at, own, len(one)).astype(np.int64)
            each = total[at]
            out[f"{kind}_{what}"] = pa.array([_pack(each[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            if kind == "words":  # once a bucket
                out["tokens" if what == "n" else "tokens_dev"] = pa.array([int(total.sum())] + [0] * (rows - 1))
                if what == "n":
                    out["types"] = pa.array([int((total > 0).sum())] + [0] * (rows - 1))
    pa.default_memory_pool().release_unused()
    return pa.table({name: out[name] for name in (f.split()[0] for f in TOTALS.split(", "))})


@dataclass
class Counted:
    """A batch's tokens with the counts that it asked for."""

    ids: pa.Array
    t: Tokens
    words_n: np.ndarray
    words_dev: np.ndarray
    context: np.ndarray  # of each distinct pair, as Tokens.pairs has them
    word: np.ndarray
    at: np.ndarray
    pairs_n: np.ndarray
    pairs_dev: np.ndarray
    start_n: int
    start_dev: int


def _counted(batch: pa.Table, totals: pa.Table) -> Counted:
    """A batch, a table of one row, with the blocks that answer it."""
    ids, t = _tokens_of(batch, 0)
    blocks = sorted(totals.to_pylist(), key=lambda x: x["bucket"])
    read = lambda kind, what: np.concatenate([_unpack(x[f"{kind}_{what}"], x[f"n_{kind}"], np.int64) for x in blocks])
    h, w, at, key = t.pairs()
    order = np.argsort(key)
    place = int(np.searchsorted(key[order], _start()))
    pairs = {}
    for what in ("n", "dev"):
        got = read("pairs", what)
        pairs[what] = np.empty(len(key), np.int64)
        pairs[what][order] = np.delete(got, place)
        pairs[f"start_{what}"] = int(got[place])
    return Counted(ids, t, read("words", "n"), read("words", "dev"), h, w, at, pairs["n"], pairs["dev"], pairs["start_n"], pairs["start_dev"])


@dataclass
class CountedTexts:
    """The batches of all texts and the blocks that answer them, both written."""

    texts: DataFrame
    totals: DataFrame

    def each(self, run: Callable[[Counted], pa.Table], schema: str) -> DataFrame:
        """What ``run`` makes of every batch.  A batch and its blocks come to Python by
        themselves: as one row of a join, or as one batch of rows, a partition's
        batches would stand in memory together."""

        def of(batch: pa.Table, totals: pa.Table) -> pa.Table:
            try:
                return run(_counted(batch, totals))
            finally:
                pa.default_memory_pool().release_unused()

        return self.texts.groupBy("batch").cogroup(self.totals.groupBy("batch")).applyInArrow(of, schema)


def bucket_of(context_counts: np.ndarray) -> np.ndarray:
    """The binary order of magnitude of each context's count; 0 for none."""
    return np.ceil(np.log2(context_counts + 1.0)).astype(np.int64)


def held_out_events(counted: CountedTexts) -> DataFrame:
    """b, d, p2 and w of the DEV rows' pairs: the bucket of c(h), how many there
    are, and their mean c(h, w) / c(h) and c(w), all without the DEV rows."""

    def run(c: Counted) -> pa.Table:
        fold = np.array([i is not None and id_mod_py(i, FOLDS) == DEV for i in c.ids.to_pylist()], bool)
        d = np.bincount(c.at, fold[c.t.text()], len(c.context))
        k = np.nonzero(d)[0]
        d, h = d[k], np.append(c.words_n - c.words_dev, c.start_n - c.start_dev)[c.context[k]]
        p2, w = (c.pairs_n - c.pairs_dev)[k] / np.maximum(1, h), (c.words_n - c.words_dev)[c.word[k]].astype(float)
        order = [np.where(x > 0, np.floor(FINE * np.log2(np.maximum(x, 1e-300))), -4096).astype(np.int64) for x in (p2, w)]
        cell, back = np.unique(np.stack([bucket_of(h), *order], 1), axis=0, return_inverse=True)
        total = lambda x: np.bincount(back.ravel(), x, len(cell)).astype(float)
        return pa.table([*[pa.array(cell[:, j]) for j in range(3)], pa.array(total(d)), pa.array(total(d * p2)), pa.array(total(d * w))], names=["b", "o2", "o1", "d", "p2", "w"])

    cells = counted.each(run, "b long, o2 long, o1 long, d double, p2 double, w double")
    summed = cells.groupBy("b", "o2", "o1").agg(*[F.sum(c).alias(c) for c in ("d", "p2", "w")])
    return summed.select("b", "d", (F.col("p2") / F.col("d")).alias("p2"), (F.col("w") / F.col("d")).alias("w"))


def learn_weights(b: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, d: np.ndarray) -> np.ndarray:
    """Weights (bucket x [bigram, unigram, uniform]) by EM on d events each with
    these estimates.  A context never seen has no bigram."""
    weights = np.tile([0.6, 0.39, 0.01], (65, 1))
    weights[0] = [0.0, 0.975, 0.025]
    parts = np.stack([p2, p1, np.full(len(b), p0)], 1)
    for _ in range(ROUNDS if len(b) else 0):
        share = weights[b] * parts
        share *= (d / share.sum(1))[:, None]
        summed = np.stack([np.bincount(b, share[:, k], len(weights)) for k in range(3)], 1)
        seen = summed.sum(1) > 0
        weights[seen] = np.maximum(summed[seen] / summed[seen].sum(1, keepdims=True), 1e-6)
        weights[0, 0] = 0.0
        weights /= weights.sum(1, keepdims=True)
    return weights


@dataclass
class Model:
    """What mixes the counts; the counts themselves come with the texts."""

    weights: np.ndarray
    tokens: int
    types: int

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def log(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of the mixed probability, from c(h, w), c(h) and c(w)."""
        if not self.tokens:
            return np.zeros(len(pair))
        f = self.weights[bucket_of(context)]
        return np.log10(f[:, 0] * pair / np.maximum(1, context) + f[:, 1] * word / self.tokens + f[:, 2] / (self.types + 1))


def counted_texts(rows: DataFrame) -> tuple[CountedTexts, dict]:
    """The batches of all texts with their counts; and tokens, tokens_dev and types
    of the training rows."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    with small_batches(rows.sparkSession):
        texts = written(batched(rows), "token-batches", group_rows=1)
    with small_batches(rows.sparkSession, TOGETHER):
        totals = written(asked(texts, buckets).groupBy("bucket").applyInArrow(_sum_bucket, TOTALS), "count-totals")
    stats = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "tokens_dev", "types")]).first().asDict()
    return CountedTexts(texts, totals.drop("tokens", "tokens_dev", "types")), stats


def fit(counted: CountedTexts, stats: dict) -> Model:
    """The mixture weights; at most one event for each cell of (bucket, order of
    p2, order of w) reaches the driver, whatever the input."""
    # Written, so that the shuffled batches go before the scores shuffle them again.
    events = written(held_out_events(counted), "held-out-events")
    got = events.toArrow()
    dropped(events)
    b, d, p2, w = (got[c].to_numpy() for c in ("b", "d", "p2", "w"))
    weights = learn_weights(b.astype(np.int64), p2, w / max(1, stats["tokens"] - stats["tokens_dev"]), 1 / (stats["types"] + 1), d)
    return Model(weights, stats["tokens"], stats["types"])


def score(counted: CountedTexts, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every text."""
    shared = counted.texts.sparkSession.sparkContext.broadcast(model)
    id_type = counted.texts.schema["ids"].dataType.elementType.simpleString()

    def run(c: Counted) -> pa.Table:
        m = shared.value
        text, n = c.t.text(), c.words_n[c.t.code]
        logs = m.log(c.pairs_n, np.append(c.words_n, c.start_n)[c.context], c.words_n[c.word])
        sums = [np.bincount(text, x, len(c.ids)) for x in (n > 0, m.base(c.words_n)[c.t.code], logs[c.at])]
        columns = [c.ids, pa.array(np.diff(c.t.ends)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return counted.each(run, f"doc_id {id_type}, n_tokens long, n_known long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_mod(doc_id, FOLDS) == HELD_OUT, F.lit(False))


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of all rows by a model learned from their training part."""
    counted, stats = counted_texts(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    model = fit(counted, stats)
    return score(counted, model).withColumn("train_tokens", F.lit(model.tokens).cast("long")).withColumn("held_out", held_out(F.col("doc_id")))


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
