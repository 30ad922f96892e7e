"""Near-duplicate lines by a segment-partition edit join, in Spark SQL only.

Lines are sequences of words.  Two lines are near-duplicates if at most
``tolerance`` words are inserted, deleted or replaced between them: none below
``LEAST`` words, then one, and one more for every ``STEP`` words of the shorter
line, up to ``MOST``.

A line of n words is cut into tolerance + 1 even segments.  If a line of at
least n words is near it, one segment occurs in that line near the place where
the length difference and the segment's number allow it (the multi-match-aware
window).  So each line is met under the hashes of its own segments and of the
few runs of its words that can match a segment of each admissible length.

Nobody pairs the lines of a key with each other at once.  First all are compared
with the most frequent line that has the segment as its own, by a banded
bit-parallel edit distance: the states of the (2 * MOST + 1)-wide band are bits,
one mask for each number of edits.  Links become classes by ``components.connected``,
so that what one class holds is never compared again.  A key whose lines now belong to
one class is done.  Of the others, those in which lines of different classes
make at most ``PAIRS`` pairs a line compare just these pairs.  The rest (a
phrase that very many lines share) are cut further: the words beside the matched
segment are again cut into tolerance + 1 segments, which gives longer keys that
fewer lines share, each with a most frequent line of its own.  What is still left after
``CUTS`` cuts gets keys of all its words that aren't matched yet, but for those that
the tolerance lets differ (``variants``).  All lines of such a key are near its most
frequent line, so they are linked with that one, however many they are.

Of each class the first line, by (id, hash of the text, place), stays.

Lines of equal words are one line, told apart by 96 bits of hashes.  Lines
without a word take no part and stay.

Defined results: null text has no lines and stays null; rows equal in id and
text are one document, rows with equal ids and different texts are not; null ids
take no part and pass unchanged; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, table, written
from .components import connected

#: Lines under LEAST words match equal lines only; STEP words allow one more edit.
LEAST, STEP, MOST = 8, 48, 2
#: Pairs of lines of different classes that a key may have for each of its lines
#: before it is cut further, and cuts at most.  A pair costs two counts of bits,
#: a cut some four entries of hashed words a line, written and grouped; the keys
#: after the last cut grow with the square of the few words that are left.
PAIRS, CUTS = 256, 4
#: Keys or line ids up to this number are broadcast (16 bytes each), more are shuffled.
BROADCAST_IDS = 500_000
#: Removed lines, and eight for each of their documents, up to this number are
#: broadcast (4 bytes each), more are shuffled.
BROADCAST_PLACES = 2_000_000
WIDTH = 2 * MOST + 1
#: From the first word of a line to the line's end.
WORDED = "[^ \\t\\n\\x0B\\f\\r][^\\n]*"


def tolerance(n: Column) -> Column:
    return F.when(n < LEAST, 0).otherwise(F.least(F.lit(MOST), (n / STEP).cast("int") + 1))


def lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy (hash of the text), place (from 0) and words of every line
    with a word, and its hashes id and more."""
    others = WS_CHARS.replace(" ", "").replace("\n", "")
    rare = F.lit(False)
    for c in others:
        rare |= F.contains(F.col(text_col), F.lit(c))
    text = F.when(rare, F.translate(F.col(text_col), others, " " * len(others))).otherwise(F.col(text_col))
    # The hash in a select of its own, else it would be taken once a line.
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("copy"), text.alias("text"))
    split = rows.select("doc_id", "copy", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    # Filtered by the line, not by its words: Spark would move that filter below and split twice.
    worded = split.filter(F.ltrim("line") != "").withColumn("words", F.array_remove(F.split("line", " "), "")).drop("line")
    return worded.withColumns({"id": F.xxhash64("words"), "more": F.hash("words")})


def _segment(m: Column, parts, i) -> tuple[Column, Column]:
    """Start and length of segment i of m words; the last ``m % parts`` are one longer."""
    short = (m / parts).cast("int")
    over = F.lit(i) - (F.lit(parts) - m % parts)
    return short * i + F.greatest(F.lit(0), over), short + (over >= 0).cast("int")


def _key(above: Column, i, words: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(above, F.lit(i), F.slice(words, start + 1, size))


def whole_lines(distinct: DataFrame) -> DataFrame:
    """The entries of uncut lines (id, words): for each length of the other line
    (m), the tolerance (t), own if the line is of that length itself, the key so
    far, and the words not yet matched (rest)."""
    n = F.size("words")
    less = F.filter(F.sequence(F.lit(0), tolerance(n)), lambda k: (k <= tolerance(n - k)) & (tolerance(n - k) > 0))
    each = distinct.select("id", F.col("words").alias("rest"), n.alias("n"), F.explode(less).alias("less"))
    m = F.col("n") - F.col("less")
    return each.select("id", "rest", m.cast("long").alias("key"), m.alias("m"), tolerance(m).alias("t"), (F.col("less") == 0).alias("own"))


def cut(entries: DataFrame) -> DataFrame:
    """The next entries of each: one for every segment and place where it may stand."""
    t, m, rest = F.col("t"), F.col("m"), F.col("rest")
    less = F.size("rest") - m

    def at(i: Column) -> Column:
        start, size = _segment(m, t + 1, i)
        shifts = F.sequence(F.greatest(-i, less - t + i), F.least(i, less + t - i))
        one = lambda s: F.struct(_key(F.col("key"), i, rest, start + s, size).alias("key"), (F.col("own") & (s == 0)).alias("own"), (start + s).alias("start"), size.alias("size"))
        return F.transform(F.filter(shifts, lambda s: (size > 0) & (start + s >= 0) & (start + s + size <= F.size(rest))), one)

    each = entries.select("id", "rest", "m", "t", F.explode(F.flatten(F.transform(F.sequence(F.lit(0), t), at))).alias("e"))
    left = F.concat(F.slice("rest", F.lit(1), F.col("e.start")), F.slice("rest", F.col("e.start") + F.col("e.size") + 1, F.size("rest")))
    return each.select("id", left.alias("rest"), "e.key", (F.col("m") - F.col("e.size")).alias("m"), "t", "e.own")


def variants(entries: DataFrame) -> DataFrame:
    """The last keys of each entry (key, id, own): the words not yet matched, after
    the edits that may lie between the line and a nearby one.

    If the other line has m words left and this one ``less`` more, x words of the other are
    deleted and less + x of this, and as many others as the tolerance still
    allows are replaced by a mark at their places.  Two lines that meet so are as near as the
    tolerance, and every two lines that are so near meet.  A line that a segment of
    its own led here stands for the other line, with every possible ``less``.
    """
    m, t, less, x = F.col("m"), F.col("t"), F.size("rest") - F.col("m"), F.col("form.x")
    forms = [(k, x) for k in range(MOST + 1) for x in range((MOST - k) // 2 + 1)]
    form = F.explode(F.array(*[F.struct(F.lit(k).alias("less"), F.lit(x).alias("x")) for k, x in forms]))
    each = entries.withColumn("form", form).filter((F.col("form.less") + 2 * x <= t) & (x <= m) & (F.col("own") | (F.col("form.less") == less)))
    marked = F.least(t - F.col("form.less") - 2 * x, m - x)
    each = each.select("id", "own", "rest", F.xxhash64("key", "form").alias("key"), (less + x).alias("gone"), marked.alias("marked"), F.lit(0).alias("at"))
    for _ in range(MOST):
        places = F.when(F.col("gone") + F.col("marked") > 0, F.sequence(F.col("at"), F.size("rest") - 1)).otherwise(F.array(F.lit(-1)))
        each = each.filter((F.col("gone") + F.col("marked") == 0) | (F.col("at") < F.size("rest")))
        each = each.withColumn("p", F.explode(places)).withColumn("mark", F.explode(F.array(F.lit(False), F.lit(True))))
        idle, mark, p = F.col("p") < 0, F.col("mark"), F.col("p")
        # An entry without an edit left goes on once.
        each = each.filter(F.when(mark, F.col("marked") > 0).otherwise(idle | (F.col("gone") > 0)))
        before, after = F.slice("rest", F.lit(1), p), F.slice("rest", p + 2, F.size("rest"))
        new = F.when(idle, F.col("rest")).when(mark, F.concat(before, F.array(F.lit("")), after)).otherwise(F.concat(before, after))
        step = lambda name, on: (F.col(name) - on.cast("int")).alias(name)
        each = each.select("id", "own", "key", new.alias("rest"), step("gone", ~mark & ~idle), step("marked", mark), F.when(idle, F.col("at")).otherwise(p + mark.cast("int")).alias("at"))
    return each.filter("gone + marked = 0").select(F.xxhash64("key", F.size("rest"), "rest").alias("key"), "id", "own")


def _windows() -> list[tuple[int, int, int, int, int]]:
    """(tolerance of the line, difference in length, tolerance of the other line,
    segment, shift) of every place where a segment may stand."""
    out = []
    for own in range(1, MOST + 1):
        for less in range(own + 1):
            for t in {own} if less == 0 else {own, own - 1}:  # a shorter line may have a smaller one
                if less <= t and t:
                    out += [(own, less, t, i, s) for i in range(t + 1) for s in range(max(-i, less - t + i), min(i, less + t - i) + 1)]
    return out


def entries_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of two kinds, made in one pass over the texts: key, id and own of the
    first cut of all lines, as ``cut`` has them; and id, more, doc_id, copy and
    place of each line.  The windows are looked up in constants, so that Spark
    compiles the whole."""
    table_ = _windows()
    column = lambda k: F.array(*[F.lit(w[k]) for w in table_])
    n, w = F.size("words"), F.col("w")
    first, last = ([[j for j, x in enumerate(table_) if x[0] == t][k] for t in range(1, MOST + 1)] for k in (0, -1))
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("t") - 1)
    able = lines(df, id_col, text_col).select("*", n.alias("n"), tolerance(n).alias("t"))
    # Window -1 is the line itself.
    windows = F.when(F.col("t") > 0, F.concat(F.array(F.lit(-1)), F.sequence(of(first), of(last)))).otherwise(F.array(F.lit(-1)))
    each = able.select("id", "more", "doc_id", "copy", "place", "words", "n", F.explode(windows).alias("w"))
    each = each.withColumns({name: F.get(column(k), F.greatest(w, F.lit(0))) for k, name in ((1, "less"), (2, "t"), (3, "i"), (4, "shift"))})
    each = each.filter((w < 0) | (tolerance(F.col("n") - F.col("less")) == F.col("t")))
    m = F.col("n") - F.col("less")
    start, size = _segment(m, F.col("t") + 1, F.col("i"))
    key = F.when(w >= 0, _key(m.cast("long"), F.col("i"), F.col("words"), start + F.col("shift"), size))
    own = (F.col("less") == 0) & (F.col("shift") == 0)
    return each.select(key.alias("key"), "id", own.alias("own"), *[F.when(w < 0, F.col(c)).alias(c) for c in ("more", "doc_id", "copy", "place")])


def keys_of(entries: DataFrame) -> DataFrame:
    return entries.filter("key is not null").select("key", "id", "own")


def places_of(entries: DataFrame) -> DataFrame:
    return entries.filter("place is not null").select("id", "more", "doc_id", "copy", "place")


def _match_masks(x: Column, y: Column) -> Column:
    """For each word of y one bit a place of the band: equal or not."""
    bit = lambda c, at, k: F.when(F.get(x, at) == c, 1 << k).otherwise(0)
    return F.transform(y, lambda c, j: sum((bit(c, j + d, d + MOST) for d in range(-MOST, MOST + 1)), F.lit(0)).cast("long"))


def _step(masks: Column, match: Column) -> Column:
    """The band's masks, one for each number of edits, after one more word."""
    full = (1 << WIDTH) - 1
    before = [F.shiftright(masks, WIDTH * e).bitwiseAND(full) for e in range(MOST + 1)]
    out, fewer = F.lit(0).cast("long"), None
    for e in range(MOST + 1):
        now = before[e].bitwiseAND(match)
        if e:  # replaced, inserted, deleted
            now = now.bitwiseOR(before[e - 1]).bitwiseOR(F.shiftright(before[e - 1], 1)).bitwiseOR(F.shiftleft(fewer, 1).bitwiseAND(full))
        out = out.bitwiseOR(F.shiftleft(now, WIDTH * e))
        fewer = now
    return out


def within_edits(a: Column, b: Column, edits: Column) -> Column:
    """Whether two arrays of words are at most ``edits`` (MOST at most) edits apart.

    After j words of b, bit d + MOST of mask e is set if the first j + d words of
    a are within e edits of them.  All masks share one 64-bit integer.
    """
    full = (1 << WIDTH) - 1
    start = sum(((((1 << (e + 1)) - 1) << MOST) & full) << (WIDTH * e) for e in range(MOST + 1))
    masks = F.aggregate(_match_masks(a, b), F.lit(start).cast("long"), _step)
    last = F.call_function("shiftright", masks, edits * WIDTH + MOST + F.size(a) - F.size(b)).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.when(F.abs(F.size(a) - F.size(b)) <= edits, last).otherwise(False)


def signature(hashed, words: Column) -> Column:
    """One bit for each value of a hash modulo 64: whether an odd number of words
    have it.  An edit changes at most two bits."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), hashed(w).bitwiseAND(63).cast("int"))))


#: Columns by which lines are told apart before their words are fetched.
MARKS = ("n", "bits", "more_bits")


def _may_be_near(a: str, b: str) -> Column:
    """By numbers of words and signatures (``MARKS`` with a suffix)."""
    edits = tolerance(F.least(f"n{a}", f"n{b}"))
    alike = F.abs(F.col(f"n{a}") - F.col(f"n{b}")) <= edits
    for bits in MARKS[1:]:
        alike &= F.bit_count(F.col(f"{bits}{a}").bitwiseXOR(F.col(f"{bits}{b}"))) <= 2 * edits
    return alike


def _small(df: DataFrame) -> DataFrame:
    """``df`` of keys or ids, broadcast if it is small, else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _met(keyed: DataFrame) -> DataFrame:
    """key, id and first of the lines that meet another line: first is the most
    frequent line that has the key's segment as its own."""
    groups = keyed.groupBy("key").agg(F.max("own").alias("own"), F.min("id").alias("_a"), F.max("id").alias("_b"))
    live = written(groups.filter("own and _a != _b").select("key"), "line-keys")
    lines_of = written(keyed.join(_small(live), "key", "left_semi").groupBy("key", "id").agg(F.max("own").alias("own"), F.count("*").alias("n")), "line-meetings")
    first = lines_of.filter("own").groupBy("key").agg(F.max(F.struct("n", "id")).alias("_m")).select("key", F.col("_m.id").alias("first"))
    return written(lines_of.select("key", "id").join(first, "key"), "line-meetings")


def _texts(df: DataFrame, met: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, words, n, bits and more_bits (signatures) of the lines that meet others, read from
    one document each."""
    wanted = written(met.select("id").distinct(), "line-ids")
    of_doc = written(places.join(_small(wanted), "id", "left_semi").groupBy("id").agg(F.min(F.struct("doc_id", "copy")).alias("_d")).select("id", "_d.*"), "line-documents")
    docs = of_doc.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct()
    some = df.join(_small(docs), (df[id_col] == F.col("_id")) & (F.xxhash64(df[text_col]) == F.col("_copy")), "left_semi")
    found = lines(some, id_col, text_col).select("id", "words").join(_small(wanted), "id", "left_semi")
    one = found.groupBy("id").agg(F.first("words").alias("words"))
    return written(one.withColumns({"n": F.size("words"), "bits": signature(F.hash, F.col("words")), "more_bits": signature(F.xxhash64, F.col("words"))}), "line-texts")


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b of lines that are near-duplicates."""
    words = texts.select("id", "words")
    both = pairs.join(words.toDF("a", "words_a"), "a").join(words.toDF("b", "words_b"), "b")
    a, b = F.col("words_a"), F.col("words_b")
    return written(both.filter(within_edits(a, b, tolerance(F.least(F.size(a), F.size(b))))).select("a", "b"), "line-links")


def _stars(marked: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of the lines of each key with its first one."""
    hubs = marked.filter("id = first").select("key", *[F.col(c).alias(f"{c}_a") for c in MARKS], F.col("id").alias("a"))
    others = marked.filter("id != first").select("key", *[F.col(c).alias(f"{c}_b") for c in MARKS], F.col("id").alias("b"))
    return _near(others.join(hubs, "key").filter(_may_be_near("_a", "_b")).select("a", "b").distinct(), texts)


def across(classed: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of a join by key that brings lines of different classes
    together: those outside the key's largest class (keys: key and that class's
    root, major) and all.  It compares at most twice as many rows as there are
    pairs of different classes, however large a class is."""
    lines_ = classed.join(_small(keys), "key")
    return lines_.filter("root != major").toDF("key", "a", *[f"{c}_a" for c in MARKS], "root_a", "major"), lines_.drop("major").toDF("key", "b", *[f"{c}_b" for c in MARKS], "root_b")


def links(df: DataFrame, entries: DataFrame | None = None, places: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs a, b of ids of near-duplicate lines, enough to connect all that are.
    entries and places: those of df, where they are written already."""
    entries = written(entries_of(df, id_col, text_col), "line-entries", dictionary=False) if entries is None else entries
    places = places_of(entries) if places is None else places
    met = _met(keys_of(entries))
    texts = _texts(df, met, places, id_col, text_col)
    marks = texts.select("id", *MARKS)
    whole, found, cuts = None, None, 0
    while True:
        marked = written(met.join(marks, "id"), "marked-lines")
        new = _stars(marked, texts)
        found = new if found is None else found.unionByName(new)
        classed = written(marked.join(connected(found).withColumnRenamed("node", "id"), "id", "left").select("key", "id", *MARKS, F.coalesce("root", "id").alias("root")), "line-classes")
        sizes = classed.groupBy("key", "root").agg(F.count("*").cast("double").alias("n"))
        sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"), F.count("*").alias("classes"), F.max(F.struct("n", "root")).alias("_m"))
        mixed = written(sizes.filter("classes > 1").select("key", F.col("_m.root").alias("major"), ((F.col("n") * F.col("n") - F.col("same")) / 2 > F.col("n") * PAIRS).alias("large")), "mixed-keys")
        a, b = across(classed, mixed.filter("not large").select("key", "major"))
        # Of two lines outside the largest class, each is on both sides.
        once = (F.col("root_b") == F.col("major")) | (F.col("a") < F.col("b"))
        pairs = a.join(b, "key").filter(once & (F.col("root_a") != F.col("root_b")) & _may_be_near("_a", "_b"))
        found = found.unionByName(_near(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), texts))
        large = mixed.filter("large").select("key")
        if large.isEmpty():
            return found
        if whole is None:
            there = classed.join(_small(large), "key", "left_semi").select("id").distinct()
            whole = cut(whole_lines(texts.join(_small(there), "id", "left_semi")))
        whole = whole.join(_small(large), "key", "left_semi")
        if cuts == CUTS:
            met = _met(written(variants(whole), "line-entries", dictionary=False))
            return found.unionByName(_stars(written(met.join(marks, "id"), "marked-lines"), texts))
        cuts += 1
        whole = written(cut(whole), "line-entries")
        met = _met(whole.select("key", "id", "own"))


def removals(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy and gone, the places of its lines that an earlier line stands for."""
    entries = written(entries_of(df, id_col, text_col), "line-entries", dictionary=False)
    places = written(places_of(entries), "line-places", dictionary=False)
    roots = written(connected(links(df, entries, places, id_col, text_col)).withColumnRenamed("node", "id"), "line-roots")
    # Only lines that occur twice or are linked can go.
    twice = places.groupBy("id", "more").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    asked = written(twice.unionByName(roots.select("id")).distinct(), "asked-lines")
    some = places.join(_small(asked), "id", "left_semi").join(roots, "id", "left")
    some = some.select(F.coalesce("root", "id").alias("root"), F.when(F.col("root").isNull(), F.col("more")).alias("more"), F.struct("doc_id", "copy", "place").alias("at"))
    some = written(some.withColumn("more", F.coalesce("more", F.lit(0))), "classed-lines")
    stays = written(some.groupBy("root", "more").agg(F.min("at").alias("stays")), "staying-lines")
    gone = some.join(_small(stays), ["root", "more"]).filter("at != stays")
    return gone.select("at.*").groupBy("doc_id", "copy").agg(F.collect_set("place").alias("gone"))


def _few_places(gone: DataFrame) -> DataFrame:
    """``removals``, broadcast if it holds few places, else joined by a shuffle."""
    total = gone.agg(F.coalesce(F.sum(F.size("gone") + 8), F.lit(0))).first()[0]
    return F.broadcast(gone) if total <= BROADCAST_PLACES else gone


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df``: row (a struct of its columns), text without the
    removed lines, n_lines (with a word, before) and n_removed."""
    gone = written(removals(df, id_col, text_col), "removed-lines").withColumnsRenamed({"doc_id": "gone_id", "copy": "gone_copy"})
    row = df.select(F.struct(*df.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = row.join(_few_places(gone), (F.col("id") == F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_copy")), "left").withColumn("parts", F.split("text", "\n"))
    parts = F.col("parts")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")
    rebuilt = F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    n_lines = F.regexp_count("text", F.lit(WORDED)).cast("long")
    return both.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(rebuilt).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(n_lines).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def filter_documents(df: DataFrame) -> DataFrame:
    """``df`` with the removed lines cut from its texts; rows that lose all
    their lines go.  n_chars follows the text where there is such a column."""
    new = dedup(df).filter("n_removed = 0 or n_removed < n_lines")
    changed = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(df.schema["n_chars"].dataType)} if "n_chars" in df.columns else {})
    return new.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in df.columns])


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    got = dedup(table(spark, sf_dir, "documents"))
    return got.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
