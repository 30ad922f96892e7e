"""Quality rules: a threshold table compiled into one Spark projection.

``METRICS`` names the measurable things, ``RULES`` is the threshold table.
``compile_rules`` turns the table into one boolean column; nothing but Spark
SQL functions runs, there is no shuffle, and each row depends on itself only.

Defined results: a null or empty text has no words and fails the base rule.
Repeated rows are measured one by one.  Extra columns are not read; a column
of the input that bears the name of an output column is left out of the output
of ``measure`` (which returns the id and the measures only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, table, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the languages served.
STOP_WORDS = (
    # English
    "the of and to in a is that for it on with as was be by are this from at or an not have "
    # German
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    # French
    "de la le et les des en un du une que est pour qui dans par au sur plus ne se aux avec "
    # Spanish
    "de la que el en y a los se del las un por con no una su para es al lo como"
).split()

#: Words in a window of the repetition measure.
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """One row of the threshold table: low <= num / den <= high; den None is 1.

    A rule with den = 0 passes.  ``least_words``: the rule holds from so many
    words on, since ratios of a few words say little.
    """

    name: str
    num: str
    den: str | None = None
    low: float | None = None
    high: float | None = None
    least_words: int = 0


#: The threshold table.
RULES = (
    Rule("words", "n_words", low=10, high=100_000_000),
    Rule("word_length", "word_chars", "n_words", low=2.0, high=12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.3),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.02, least_words=30),
    Rule("shout_ratio", "n_shouts", "n_words", high=0.3),
    Rule("adjacent_repeat_ratio", "n_adjacent", "n_words", high=0.2),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", high=0.4, least_words=30),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", high=0.3, least_words=30),
)


def compile_rules(rules=RULES) -> Column:
    """The table as one boolean column over the measures: true if all rules hold."""
    verdict = F.lit(True)
    for r in rules:
        num = F.col(r.num).cast("double")
        den = F.lit(1.0) if r.den is None else F.col(r.den).cast("double")
        held = F.lit(True)
        if r.low is not None:
            held = held & (num >= den * r.low)
        if r.high is not None:
            held = held & (num <= den * r.high)
        verdict = verdict & (held | (F.col("n_words") < r.least_words) | (den == 0))
    return verdict


def _covered(positions: Column) -> Column:
    """Words that windows starting at the sorted ``positions`` cover together."""
    steps = F.transform(positions, lambda p, k: F.least(F.lit(WINDOW), F.get(positions, k + 1) - p))
    return F.aggregate(steps, F.lit(0), lambda a, s: a + s).cast("long")


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and all measures of every row's whole text."""
    text, n = F.col("_text"), F.size("_words")
    not_blank = lambda line: F.length(F.btrim(line, F.lit(WS_CHARS))) > 0
    size_of = lambda array: F.size(array).cast("long")
    hash_of = F.transform("_words", lambda w: F.xxhash64(w))
    at = lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(WINDOW)])
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), at)).otherwise(F.array().cast("array<bigint>"))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    by_hash = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    twice = F.filter("_sorted", lambda s, k: F.coalesce(s["h"] == F.get("_sorted", k - 1)["h"], F.lit(False)) | F.coalesce(s["h"] == F.get("_sorted", k + 1)["h"], F.lit(False)))
    return (
        df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .withColumn("_words", words(text))
        .withColumn("_lines", F.filter(F.split(text, "\n"), not_blank))
        .withColumn("_hashes", hash_of)
        .withColumn("_windows", windows)
        .withColumn("_sorted", F.when(repeats, by_hash).otherwise(none))
        .withColumn("_repeated", F.sort_array(F.transform(twice, lambda s: s["i"])))
        .select(
            "doc_id",
            size_of("_words").alias("n_words"),
            F.length(F.translate(text, WS_CHARS, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _covered(F.col("_repeated")).alias("n_repeat_words"),
            size_of("_lines").alias("n_lines"),
            size_of(F.filter("_words", lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
            F.regexp_count(text, F.lit("!!")).cast("long").alias("n_shouts"),
            size_of(F.filter("_hashes", lambda h, i: h == F.get("_hashes", i - 1))).alias("n_adjacent"),
            size_of(F.filter("_lines", lambda line: line.rlike("(\\.\\.\\.|…)[ \\t\\r]*$"))).alias("n_ellipsis_lines"),
        )
    )


def judge(measures: DataFrame, rules=RULES) -> DataFrame:
    """``measure``'s rows with base_failed and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures.withColumn("base_failed", failed).withColumn("kept", ~failed & compile_rules(rules))


def filter_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, with all their columns.

    The row travels beside the measures as one struct, so that no column of
    the input can clash and rows with equal ids stay apart.
    """
    whole = F.struct(*[F.col(c) for c in df.columns])
    row = df.select(whole.alias("doc_id"), F.col(text_col).alias("text"))
    # The row number keeps Catalyst from pushing the filter below the measures,
    # which would repeat every expression that they share.
    numbered = judge(measure(row)).withColumn("_nth", F.monotonically_increasing_id())
    return numbered.filter("kept and _nth >= 0").select("doc_id.*")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(measure(table(spark, sf_dir, "documents").select("doc_id", "text")))


def oracle() -> str:
    """The same as DuckDB SQL, the threshold table compiled likewise."""
    held = []
    for r in RULES:
        den = "1.0::DOUBLE" if r.den is None else f"{r.den}::DOUBLE"
        bounds = [f"{r.num}::DOUBLE >= {den} * {r.low}::DOUBLE"] * (r.low is not None) + [f"{r.num}::DOUBLE <= {den} * {r.high}::DOUBLE"] * (r.high is not None)
        held.append(f"(({' AND '.join(bounds)}) OR n_words < {r.least_words} OR {den} = 0)")
    stop = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: trim(x, {white}) <> '') AS ls FROM d),
win AS (SELECT doc_id, i, ws[i:i+4] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS r FROM (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1), (SELECT unnest(range(0, 5)) AS o) GROUP BY 1),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(translate(t, {white}, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines, len(list_filter(ws, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
  len(regexp_extract_all(t, '!!'))::BIGINT AS n_shouts, len(list_filter(range(2, len(ws) + 1), lambda j: ws[j] = ws[j - 1]))::BIGINT AS n_adjacent,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\r]*$')))::BIGINT AS n_ellipsis_lines FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {" AND ".join(held)} AS kept FROM b"""
