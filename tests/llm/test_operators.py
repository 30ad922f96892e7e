"""Each operator against brute force, with null, empty, long, tied and repeated rows,
empty tables and extra columns that bear the names of outputs."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsflow.llm import bpe, common, components, covertree, cuts, langid, licenses, line_dedup, lm, packing, quality, simhash, warc

SPACE = "\x20\t\n\x0b\f\r"
TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h i j", "the same line\nthe same line\nthe same line", "x y z　w \x1c v", "don't  STOP  we've\n\n\n  12.5 %%% $$$ || <b>&",
    "日本語 の 文章 です。 Привет мир, это текст", "🙂🙂 ok 🙂", "word " * 5000, "a" * 3000, "The quick brown fox jumps over the lazy dog and then the quick brown fox jumps over it again.",
    "The quick brown fox jumps over the lazy dog and then the quick brown fox jumps over it again.", "hello <|endoftext|> is text <pad> <s>", "<|endoftext|><|endoftext|>\n\n", "...\n…\nshort\n - bullet",
]
EXTRA = "n_words long, fp string, lang string, kept string, score string, key string, id string, row string, gone string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, *[None if j else 0 for j in range(9)]) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")
    return df.unionByName(df.filter("doc_id = 4"))  # a repeated row


def words(text):
    return re.findall(f"[^{SPACE}]+", text or "")


def test_quality_measures(docs):
    got = quality.judge(quality.measure(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        t = TEXTS[r["doc_id"]] or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        wins = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if wins[tuple(w[i : i + 5])] > 1 for k in range(5)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_filter_keeps_columns_and_rows(docs):
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert quality.filter_documents(docs.limit(0)).count() == 0


def test_quality_is_native(docs):
    assert "Python" not in quality.judge(quality.measure(docs))._jdf.queryExecution().executedPlan().toString()


def test_bpe_equals_the_library(docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = bpe.decode(bpe.encode(docs, path, P.PATTERN), path).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        t = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == own.encode_ordinary(t) and bytes(r["decoded"]) == t.encode()
    assert bpe.encode(docs.limit(0), path, P.PATTERN).count() == 0


def test_bpe_of_random_text():
    import random

    import pyarrow as pa
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    e = bpe.encoder(path, P.PATTERN)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["".join(rng.choice([" ", "  ", "\n", "a", "The", "é", "1", "!", "'s", " \n", "\r", "．", "🙂", ",", "\u2003", "\x85", "\x1c", "x\ny", ", b"]) for _ in range(rng.randrange(80))) for _ in range(3000)]
    ids, ends = e.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [own.encode_ordinary(t) for t in texts]


def test_known_cuts_start_anew_but_answer_alike():
    import pyarrow as pa

    known = cuts.Known(3)
    encode = lambda words: (np.array([int(c) for w in words.to_pylist() for c in w], np.int32), np.array([len(w) for w in words.to_pylist()]))
    for k in range(20):
        asked = [str(k), str(k + 1), str(k)]
        at = known.get(pa.array(asked, pa.large_string()), encode)
        assert [known.ids[known.ends[i] : known.ends[i + 1]].tolist() for i in at] == [[int(c) for c in w] for w in asked]
        assert len(known.cuts) <= 3


def test_packing(docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    repeated = packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    assert sorted(r["sequence_id"] for r in repeated) == list(range(len(repeated)))
    assert Counter((r["start"], bytes(r["ids"])) for r in repeated if r["doc_id"] == 4) == Counter({(s, i): 2 for s, i in {(r["start"], bytes(r["ids"])) for r in repeated if r["doc_id"] == 4}})
    assert packing.pack(docs.limit(0), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    got = packing.pack(docs.filter("doc_id != 4"), P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    by_doc = defaultdict(list)
    for r in sorted(got, key=lambda r: r["start"]):
        by_doc[r["doc_id"]].append(r)
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    for k, t in enumerate(TEXTS):
        if k == 4:
            continue
        want = own.encode(t or "", add_special_tokens=False).ids + [1]
        assert [i for r in by_doc[k] for i in np.frombuffer(r["ids"], "<u4").tolist()] == want
        assert all(r["doc_tokens"] == len(want) and 4 * r["length"] == len(r["ids"]) and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0 for r in by_doc[k])
    by_id = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_id] == sorted(r["length"] for r in got)
    d = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.digests(packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN)).collect()}
    assert all(d[r["doc_id"], r["start"]] == zlib.crc32(r["ids"]) for r in got)
    assert packing.lengths(2049 + 5) == [2048, 4, 2]
    with pytest.raises(ValueError):
        packing.pieces(docs, "", "", longest=1000)


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def tolerance(n):
    return 0 if n < line_dedup.LEAST else min(line_dedup.MOST, 1 + n // line_dedup.STEP)


def line_classes(found):
    """The smallest of the lines (tuples of words) that each is linked with."""
    found = sorted(set(found))
    root = {x: x for x in found}
    near = [(a, b) for i, a in enumerate(found) for b in found[i + 1 :] if (t := tolerance(min(len(a), len(b)))) and abs(len(a) - len(b)) <= t and edit_distance(a, b) <= t]
    for _ in found:
        before = dict(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def near_lines(seed, words_of, edits):
    import random

    rng = random.Random(seed)
    out = []
    for _ in range(8):
        n = rng.choice([7, 8, 9, 16, 30, 47, 48, 49, 50, 97, 150, 195])
        base = [rng.choice(words_of) for _ in range(n)]
        out.append(base)
        for _ in range(6):
            line = list(rng.choice(out[-4:]))
            for _ in range(rng.randrange(edits + 1)):
                k = rng.randrange(len(line))
                line[k : k + rng.randrange(2)] = rng.choice([["new"], [], [rng.choice(words_of)]])
            out.append(line)
    return [x for x in out if x]


@pytest.mark.parametrize(("case", "pairs"), [((1, [f"w{k}" for k in range(40)], 5), 64), ((2, ["a", "b"], 3), 0)])
def test_edit_join_finds_the_classes_of_all_pairs(spark, monkeypatch, case, pairs):
    monkeypatch.setattr(line_dedup, "PAIRS", pairs)  # 0: all keys of two classes are cut
    found = near_lines(*case)
    # Lines that share a half and nothing else, and a chain of single edits.
    found += [["the", "same", "four", "words"] + [f"o{k}{j}" for j in range(4)] for k in range(30)]
    found += [[f"c{j}" if j >= k else f"d{j}" for j in range(9)] for k in range(9)]
    df = spark.createDataFrame([(k, "  ".join(x)) for k, x in enumerate(found)], "doc_id long, text string")
    words_of = {r["id"]: tuple(r["words"]) for r in line_dedup.lines(df).collect()}
    roots = {r["node"]: r["root"] for r in components.connected(line_dedup.links(df)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for i, w in words_of.items():
        got[roots.get(i, i)].add(w)
    for w, r in line_classes(words_of.values()).items():
        want[r].add(w)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("cuts", [0, 1])
def test_lines_left_after_the_last_cut_meet_by_all_their_words(spark, monkeypatch, cuts):
    import random

    monkeypatch.setattr(line_dedup, "PAIRS", 0)
    monkeypatch.setattr(line_dedup, "CUTS", cuts)
    rng = random.Random(cuts)
    found = []
    for n in (7, 8, 9, 10, 48, 49):  # a phrase that all share, and few other words
        base = ["p"] * (n - 4) + ["a", "b", "a", "b"]
        found.append(base)
        for _ in range(12):
            line = list(rng.choice(found[-3:]))
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(line) - 4, len(line))
                line[k : k + rng.randrange(2)] = rng.choice([["new"], [], ["a"], ["b"], ["c"]])
            found.append(line)
    df = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(found)], "doc_id long, text string")
    words_of = {r["id"]: tuple(r["words"]) for r in line_dedup.lines(df).collect()}
    linked = line_dedup.links(df).collect()
    roots = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(linked, "a long, b long")).collect()}
    want = line_classes(words_of.values())
    for i, w in words_of.items():
        for j, v in words_of.items():
            assert (roots.get(i, i) == roots.get(j, j)) == (want[w] == want[v]), (w, v)


def brute_variants(rest, m, t, own):
    """(less, x, words, marks included) of an entry."""
    out = set()
    for less in range(t + 1):
        for x in range((t - less) // 2 + 1):
            gone = len(rest) - m + x
            if x <= m and (own or less == len(rest) - m):
                for left in combinations(range(len(rest)), len(rest) - gone):
                    for at in combinations(left, min(t - less - 2 * x, len(left))):
                        out.add((less, x, tuple("" if k in at else rest[k] for k in left)))
    return out


def test_variants_equal_all_choices_of_edits(spark):
    letters = "abcdefg"
    cases = [(letters[:n], m, t, own) for n in range(8) for t in (1, 2) for m in range(max(0, n - t), n + 1) for own in {False, m == n}]
    df = spark.createDataFrame([(k, list(r), 5, m, t, own) for k, (r, m, t, own) in enumerate(cases)], "id long, rest array<string>, key long, m int, t int, own boolean")
    got = defaultdict(set)
    for r in line_dedup.variants(df).collect():
        got[r["id"]].add(r["key"])
    # Equal keys of different entries are equal choices, and the other way round.
    want = {k: brute_variants(*c) for k, c in enumerate(cases)}
    assert {k: len(v) for k, v in want.items()} == {k: len(got[k]) for k in want}
    for a, b in combinations(want, 2):
        assert len(want[a] & want[b]) == len(got[a] & got[b])


def test_a_large_class_of_a_key_is_not_compared_with_itself(spark):
    for n in (100, 1000):  # one class of n lines and two others of a line each
        classed = spark.range(n + 2).selectExpr("7L as key", "id", "9 as n", "0L as bits", "0L as more_bits", f"if(id < {n}, 0L, id) as root")
        a, b = line_dedup.across(classed, spark.createDataFrame([(7, 0)], "key long, major long"))
        assert (a.count(), b.count()) == (2, n + 2)


def test_compiled_segments_equal_the_cut_ones(spark):
    df = spark.createDataFrame([(n, " ".join(f"w{k}" for k in range(n))) for n in [1, 7, 8, 9, 31, 46, 47, 48, 49, 50, 51, 96, 100, 148, 200]], "doc_id long, text string")
    distinct = line_dedup.lines(df).select("id", "words")
    plain = line_dedup.cut(line_dedup.whole_lines(distinct)).select("key", "id", "own")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, line_dedup.keys_of(line_dedup.entries_of(df)).collect()))


def test_banded_distance_equals_the_plain_one(spark):
    import random

    rng = random.Random(3)
    rows = [([rng.choice("abc") for _ in range(rng.randrange(12))], [rng.choice("abc") for _ in range(rng.randrange(12))], rng.randrange(line_dedup.MOST + 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, e int")
    got = df.select("a", "b", "e", line_dedup.within_edits(F.col("a"), F.col("b"), F.col("e")).alias("near")).collect()
    assert all(r["near"] == (edit_distance(r["a"], r["b"]) <= r["e"]) for r in got)


def brute_line_dedup(rows):
    """(text, n_lines, n_removed) of each (id, text), as dedup has them; ids not
    null and not repeated."""
    split = lambda text: [tuple(words(x)) for x in text.split("\n")] if text is not None else []
    root = line_classes(w for _, t in rows for w in split(t) if w)
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for k, w in enumerate(split(t)):
            if w:
                first.setdefault(root[w], (i, k))
    out = {}
    for i, t in rows:
        stays = [k for k, w in enumerate(split(t)) if not w or first[root[w]] == (i, k)]
        out[i] = (None if t is None else "\n".join(t.split("\n")[k] for k in stays), sum(map(bool, split(t))), len(split(t)) - len(stays))
    return out


def test_line_dedup_equals_brute_force(spark):
    import random

    rng = random.Random(9)
    pool = [" ".join(x) for x in near_lines(8, [f"w{k}" for k in range(30)], 3)] + ["", " ", "\r\x0b", "\x0cshort\rline", "short line", "short\tline"]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 7)))) for k in range(60)] + [(100, None), (101, "")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "text", "n_lines", "n_removed").collect()}
    assert got == brute_line_dedup(rows)


def test_line_dedup_keeps_first_lines(spark):
    a, b = "a line that is long enough to be compared", "a line that is long enough to bee compared"
    df = spark.createDataFrame([(1, f"{a}\n\nshort"), (2, f"{b}\nown line of the second document"), (3, a), (4, None), (5, ""), (6, "short\n \n"), (None, a)], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup(df).select("row.doc_id", "text", "n_lines", "n_removed").collect()}
    assert got == {1: (f"{a}\n\nshort", 2, 0), 2: ("own line of the second document", 2, 1), 3: ("", 1, 1), 4: (None, 0, 0), 5: ("", 0, 0), 6: (" \n", 1, 1), None: (a, 1, 0)}
    kept = line_dedup.filter_documents(df)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 4, 5] and kept.schema == df.schema
    assert line_dedup.filter_documents(df.limit(0)).count() == 0


def test_line_dedup_of_equal_ids(spark):
    rows = [(1, "first\nsecond"), (5, "second\nunique to this row"), (5, "unique to that row\nsecond"), (5, "unique to that row\nsecond")]
    got = sorted(r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == ["first\nsecond", "unique to that row", "unique to that row", "unique to this row"]


def test_line_dedup_of_odd_texts_is_native(docs):
    assert line_dedup.dedup(docs).count() == docs.count()
    assert "Python" not in line_dedup.dedup(docs)._jdf.queryExecution().executedPlan().toString()


def test_language_spans(spark):
    en = "the house and the garden of the king with a river"
    de = "das haus und der garten des königs mit einem fluss"
    ru = "дом и сад короля с рекой"
    rows = [(k, x, lang) for k, (x, lang) in enumerate([(en, "en"), (de, "de"), (ru, "ru")] * 20)]
    m = langid.fit(langid.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert m.languages == ["de", "en", "ru"]
    asked = [(0, f"{en} {en} {de}"), (1, f"{ru} {en} {ru} {ru}"), (2, None), (3, "12 ... !!"), (4, ""), (5, de), (5, de), (None, en)]
    got = langid.predict(spark.createDataFrame(asked, "doc_id long, text string"), m).collect()
    assert [(r["lang_pred"], r["n_spans"]) for r in got] == [("en", 2), ("ru", 3), ("und", 0), ("und", 0), ("und", 0), ("de", 1), ("de", 1), ("en", 1)]
    assert all(0 <= r["score"] <= 1 for r in got)
    none = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame(asked[:2], "doc_id long, text string"), none).collect()] == ["und", "und"]


def test_viterbi_equals_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    scores, begin = rng.normal(size=(6, 3)) * 3, np.array([0, 4, 4, 9, 10])
    code = rng.integers(0, 6, 10)
    got = langid.viterbi(scores, code, begin, 2.0)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        cost = lambda p, a=a, b=b: sum(scores[code[a + i], s] for i, s in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:], strict=False))
        best = max(itertools.product(range(3), repeat=b - a), key=cost, default=())
        assert cost(tuple(got[a:b])) == pytest.approx(cost(best))


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.\nThe above copyright notice and this permission notice shall be included.\nThe software is provided \"as is\", without warranty of any kind."
    rows = [(0, mit), (1, "Text.\nReleased under the MIT License."), (2, "# Licensed under the Apache License,\n# Version 2.0."), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "A new licence of ours applies."), (5, None), (6, ""), (6, "")]
    got = [(r["doc_id"], r["licenses"], r["unknown"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert got == [(0, ["MIT"], []), (1, ["MIT"], []), (2, ["Apache-2.0"], []), (3, ["GPL-3.0-only"], []), (4, [], ["Unknown"]), (5, [], []), (6, [], []), (6, [], [])]


def test_licenses_apart_and_repeated(spark):
    gpl2, later = "Under the GNU General Public License version 2.", "Either version 2 of the License, or any later version."
    asked = [
        ("Released under the MIT License. Available under the MIT License.", ["MIT"], []),
        (f"{gpl2} Released under the MIT License. {later}", ["GPL-2.0-only", "MIT"], ["Gpl2Later"]),
        (f"{gpl2} {later}", ["GPL-2.0-or-later"], []),
        ("x " * 20000 + "\n\nReleased under the MIT License.", ["MIT"], []),
    ]
    df = spark.createDataFrame([(k, a[0]) for k, a in enumerate(asked)], "doc_id long, text string").withColumn("licenses", F.lit("clash"))
    assert [(r["licenses"], r["unknown"]) for r in licenses.scan(df).collect()] == [a[1:] for a in asked]
    assert licenses.scan(df.limit(0)).count() == 0


def test_licenses_in_one_sentence(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    apache = 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.'
    asked = [
        (gpl.format("", 3), ["GPL-3.0-or-later"]), (gpl.format("", 2), ["GPL-2.0-or-later"]), (gpl.format("Lesser ", 3), ["LGPL"]), (gpl.format("Affero ", 3), ["AGPL"]), (apache, ["Apache-2.0"]),
        ("You may redistribute it and/or modify it under the terms of the GNU General Public License version 2.", ["GPL-2.0-only"]), ("Redistribute it and/or modify it under the terms of the GNU General Public License.", ["GPL"]),
        ("Available as CC BY 4.0", ["CC-BY-4.0"]), ("Texts are CC-BY-SA-4.0.", ["CC-BY-SA-4.0"]), ("Creative\nCommons Zero", ["CC0-1.0"]), ("Released under CC0 1.0.", ["CC0-1.0"]), ("It is in the public\ndomain.", ["Public-Domain"]),
    ]
    got = licenses.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(asked)], "doc_id long, text string")).collect()
    assert [r["licenses"] for r in got] == [x for _, x in asked]
    assert not any(r["unknown"] for r in got)
    assert [r["n_sentences"] for r in got] == [2] * 4 + [1] * 8


def test_license_sql_on_notices(spark, tmp_path):
    """Notices of several identifiers a sentence, rules beside each other, other keywords."""
    import duckdb

    later = ["either version {} of the License, or (at your option) any later version", "version {} or any later version", "version {}"]
    gpl = ["redistribute it and/or modify it under the terms of the GNU General Public License", "the GNU Lesser General Public License", "the GNU Affero General Public Licence", "the GNU General Public License version 2", "GNU General Public License v3"]
    other = ["CC BY-NC 4.0", "Creative Commons Zero", "éGNU d'é", "Released under the MIT License", "SPDX-License-Identifier: GPL-3.0", "A new licence of ours", "It is in the public\ndomain", "Neither the name of X nor of Y may be used to endorse or promote Z"]
    texts = [f"{g}, {x.format(v)}. {o}.\r\n\r\n{o}! {g}." for g in gpl for x in later for v in (2, 3) for o in other]
    texts += ["; ".join(other), ". ".join(other * 50), *TEXTS]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cur = con.execute(licenses.oracle())
    names = [d[0] for d in cur.description]
    got = licenses.op7_license_scan(spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
    assert sum(r["licenses"] > "" for r in got) > 200 and max(r["n_sentences"] for r in got) > 50


def test_revisits(spark):
    h = lambda **x: [(k.replace("_", "-"), v) for k, v in x.items()]
    url = "http://www.Example.org:80/a/?b=2&utm_source=x&a=1#f"
    rows = [
        (1, "https://example.org/a?a=1&b=2", 100, "response", 200, h(ETag='"x"', Content_Type="text/html", Date="old"), "body one"),
        (2, url, 5000, "response", 200, h(ETag='"y"', last_modified="m"), "body two"),
        (3, url, 5000, "response", 404, h(ETag='"z"'), "error"),
        (10, url, 4000, "revisit", 304, h(etag='W/"x"', date="new", content_type="no"), None),
        (11, url, 5000, "revisit", 304, h(etag='"x"'), None),
        (12, url, 9000, "revisit", 304, h(last_modified="m"), None),
        (12, url, 9000, "revisit", 304, h(last_modified="m"), None),
        (13, url, 9000, "revisit", 304, None, None),
        (14, url, 9000, "revisit", 304, h(etag='"q"'), None),
        (15, url, 100, "revisit", 304, h(etag='"x"'), None),
        (16, None, 100, "revisit", 304, h(etag='"x"'), None),
        (17, url, None, "revisit", 304, h(etag='"x"'), None),
    ]
    df = spark.createDataFrame(rows, f"record_id long, url string, at long, kind string, status int, headers {warc.HEADERS}, body string").withColumn("outcome", F.lit(1)).withColumn("response", F.lit(2))
    got = {r["record_id"]: r for r in warc.resolve(df).collect()}
    assert warc.resolve(df).count() == 9 and warc.resolve(df.limit(0)).count() == 0
    tied = df.unionByName(df.filter("record_id = 1").withColumn("body", F.lit("a smaller body")))
    assert {r["body"] for r in warc.resolve(tied).filter("response_id = 1 and outcome = 'resolved'").collect()} == {"a smaller body"}
    assert {k: (r["outcome"], r["response_id"], r["body"]) for k, r in got.items()} == {
        10: ("resolved", 1, "body one"), 11: ("resolved", 1, "body one"), 12: ("resolved", 2, "body two"), 13: ("no_validator", 2, None), 14: ("validator_mismatch", 2, None),
        15: ("no_earlier_response", None, None), 16: ("no_earlier_response", None, None), 17: ("no_earlier_response", None, None),
    }
    assert [tuple(x) for x in got[10]["headers"]] == [("Content-Type", "text/html"), ("etag", 'W/"x"'), ("date", "new")]
    assert got[10]["url"] == "example.org/a?a=1&b=2"


def test_components(spark):
    import random

    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, 7), (None, 3), (5, 900)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(1000, k) for k in range(1001, 1200)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(edges + edges, "a long, b long")).collect()}
    label = {}
    for a, b in [e for e in edges if None not in e and e[0] != e[1]] * 60:
        label[a] = label[b] = min(label.get(a, a), label.get(b, b))
    assert got == label
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cover_tree_prunes_clustered_rows():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(12, 16))
    x = np.concatenate([c + rng.normal(size=(40, 16)) * 0.05 * (1 + k % 3) for k, c in enumerate(centers)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    weight, seen = rng.integers(1, 4, len(x)), {}
    tree = covertree.Node(x, np.arange(len(x)), 0)
    stack = [tree]
    while stack:
        n = stack.pop()
        assert (np.linalg.norm(x[n.rows] - x[n.center], axis=1) <= n.radius + 1e-12).all()
        if n.children:
            assert n.children[0].center == n.center and sorted(np.concatenate([c.rows for c in n.children])) == sorted(n.rows)
            assert all(c.radius <= n.radius / 2 for c in n.children)
            stack += n.children
    total, i, j = covertree.dual(x, weight, 0.93, tree, None, seen)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    assert (total == near @ weight).all() and tree.depth() > 3
    everything = len(x) * (len(x) - 1) // 2
    assert seen["pruned"] > 0 and seen["whole"] > 0 and seen["visited"] < everything / 2
    half = np.arange(len(x)) % 2 == 0
    sides = [covertree.Node(x, np.nonzero(s)[0], int(np.nonzero(s)[0][0])) for s in (half, ~half)]
    total, i, j = covertree.dual(x, weight, 0.93, *sides)
    assert (total == (near & (half[:, None] ^ half)) @ weight).all()


@pytest.mark.parametrize("cell", [4096, 7])
def test_embeddings(spark, monkeypatch, cell):
    monkeypatch.setattr(covertree, "CELL", cell)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 8))
    vecs = [(k, (base[k % 6] + rng.normal(size=8) * 0.12).tolist(), k % 2) for k in range(60)]
    vecs += [(100, vecs[3][1], 1), (101, [2 * x for x in vecs[3][1]], 1), (102, vecs[3][1], None), (103, None, 1), (104, [0.0] * 8, 1), (105, [float("nan")] + [1.0] * 7, 1), (106, [1.0, 2.0], 1), (107, [], 1), (108, [None] * 8, 1)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("x")).withColumn("unit", F.lit("y"))
    ok = {i: np.array(v) / np.linalg.norm(v) for i, v, lab in vecs if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    lab = {i: x for i, _, x in vecs}
    links = {i: {j for j in ok if j != i and lab[i] == lab[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.93} if i in ok else set() for i, _, _ in vecs}
    comp = {i: i for i in links}
    for _ in range(len(comp)):
        comp = {i: min([comp[i], *(comp[j] for j in links[i])]) for i in comp}
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in covertree.links(df).collect()}
    assert got == {i: (len(links[i]), comp[i], comp[i] == i) for i in links}
    assert covertree.links(df.limit(0)).count() == 0


def brute_lm(texts):
    """Scores of (id, text) rows by plain counting, and the weights."""
    fold = lambda i: -1 if i is None else zlib.crc32(str(i).encode()) % 10
    toks = [(fold(i), [None, *words(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "\n"]) for i, t in texts]

    def counts(which):
        c1, c2 = Counter(), Counter()
        for f, t in toks:
            if which(f):
                c1.update(t)
                c2.update(zip(t, t[1:], strict=False))
        return c1, c2, sum(n for w, n in c1.items() if w is not None)

    c1, c2, n = counts(lambda f: f > 0)
    r1, r2, rn = counts(lambda f: f > 1)
    v = len(c1) - (None in c1)
    bucket = lambda c: math.ceil(math.log2(c + 1))
    weights = defaultdict(lambda: [0.6, 0.39, 0.01], {0: [0.0, 0.975, 0.025]})
    events = [(bucket(r1[h]), r2[h, w] / max(1, r1[h]), r1[w] / max(1, rn), 1 / (v + 1)) for f, t in toks if f == 1 for h, w in zip(t, t[1:], strict=False)]
    for _ in range(lm.ROUNDS):
        sums = defaultdict(lambda: [0.0, 0.0, 0.0])
        for b, *p in events:
            total = sum(x * y for x, y in zip(weights[b], p, strict=True))
            for k in range(3):
                sums[b][k] += weights[b][k] * p[k] / total
        for b, s in sums.items():
            new = [max(x / sum(s), 1e-6) if b or k else 0.0 for k, x in enumerate(s)]
            weights[b] = [x / sum(new) for x in new]
    out = []
    for (_, t), (i, _) in zip(toks, texts, strict=True):
        mixed = lambda h, w: sum(x * y for x, y in zip(weights[bucket(c1[h])], (c2[h, w] / max(1, c1[h]), c1[w] / n, 1 / (v + 1)), strict=True))
        pairs = list(zip(t, t[1:], strict=False))
        out.append((i, len(pairs), sum(c1[w] > 0 for _, w in pairs), sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for _, w in pairs), sum(math.log10(mixed(h, w)) for h, w in pairs)))
    return out, weights, n


@pytest.mark.parametrize("small", [False, True])
def test_lm_scores_equal_plain_counting(docs, spark, monkeypatch, small):
    import random

    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(60)], k=rng.randrange(12)))) for k in range(300)]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(k + 1000, t + " Rare pair" * (k % 3)) for k, t in rows] + [(None, "w0 w1 w0"), (None, "w0 w1"), (1000, "other text, equal id")]
    if small:  # several batches and buckets
        monkeypatch.setattr(lm, "BUCKET_BYTES", 4000)
        monkeypatch.setattr(lm, "BYTES", 3000)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    want, weights, n = brute_lm(rows)
    got = lm.score_documents(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[3], 5))
    pairs = list(zip(sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got), key=key), sorted(want, key=key), strict=True))
    assert all(a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9) for a, b in pairs)
    # Estimates are summed by cells before the weights are learned.
    assert all(a[4] == pytest.approx(b[4], rel=5e-3) for a, b in pairs)
    assert {r["train_tokens"] for r in got} == {n} and all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in got)
    counted, stats = lm.counted_texts(df.select("doc_id", "text"))
    model = lm.fit(counted, stats)
    assert all(model.weights[b] == pytest.approx(w, abs=0.02) for b, w in weights.items())


def test_lm_without_training_rows(spark):
    held = [k for k in range(60) if not zlib.crc32(str(k).encode()) % 10]
    df = spark.createDataFrame([(k, "a b c") for k in held] + [(None, "a")], "doc_id long, text string")
    assert {(r["n_tokens"], r["score"]) for r in lm.score_documents(df).collect()} == {(4, 0.0), (2, 0.0)}
    assert lm.score_documents(df.limit(0)).count() == 0


def test_lm_batches_never_stand_in_memory_together(spark, tmp_path, monkeypatch):
    """No row group, which writers and readers hold whole, has two batches of a
    partition or what all buckets answered to several."""
    import pyarrow.parquet as pq

    monkeypatch.setattr("obsflow.llm.common.shared_dir", lambda spark: f"file://{tmp_path}")
    n = 20 * lm.ROWS + 1
    df = spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.col("id") % 97, F.col("id") % 89, F.lit("b")).alias("text"))
    got = lm.score_documents(df)
    assert got.count() == n and got.select("doc_id").distinct().count() == n
    files = [pq.ParquetFile(p) for p in tmp_path.rglob("*.parquet")]
    whole = {"codes", "totals"}  # columns of a batch's own size
    rows = [f.metadata.row_group(k).num_rows for f in files if whole & set(f.schema_arrow.names) for k in range(f.num_row_groups)]
    assert rows == [1] * 21


def test_lm_slices_are_full_and_keep_all_rows(monkeypatch):
    monkeypatch.setattr(lm, "ROWS", 4)
    monkeypatch.setattr(lm, "BYTES", 10)
    rng = np.random.default_rng(3)
    for _ in range(200):
        sizes = [None if s < 0 else int(s) for s in rng.integers(-1, 14, rng.integers(0, 30))]
        ids, texts = list(range(len(sizes))), [None if s is None else "x" * s for s in sizes]
        cuts = [0, *sorted(rng.integers(0, len(ids) + 1, 4)), len(ids)]
        batches = [pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), pa.array(texts[i:j], pa.string())], names=["id", "text"]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        got = [b.to_pydict() for b in lm._slices(iter(batches))]
        assert [i for b in got for i in b["id"]] == ids and [t for b in got for t in b["text"]] == texts
        size = lambda b: sum(len(t or "") for t in b["text"])
        assert all(0 < len(b["id"]) <= 4 and (size(b) <= 10 or len(b["id"]) == 1) for b in got)
        # The first row of the next one wouldn't have fitted.
        assert all(len(a["id"]) == 4 or size(a) + len(b["text"][0] or "") > 10 for a, b in zip(got, got[1:], strict=False))


def test_lm_learns_weights_exactly_from_exact_events():
    rng = np.random.default_rng(1)
    b, p2, p1, d = rng.integers(0, 4, 200), rng.random(200), rng.random(200) / 10, rng.integers(1, 5, 200).astype(float)
    p2[b == 0] = 0
    got = lm.learn_weights(b, p2, p1, 0.001, d)
    assert np.allclose(got.sum(1), 1) and got[0, 0] == 0
    for k in range(1, 4):
        here = b == k
        likelihood = lambda w, here=here: (d[here] * np.log(w[0] * p2[here] + w[1] * p1[here] + w[2] * 0.001)).sum()
        assert all(likelihood(got[k]) >= likelihood(w) - 0.5 for w in rng.dirichlet([1, 1, 1], 300))


def test_golay_keys_meet_within_three_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    _, keys, rows = simhash.golay_keys(a.view(np.int64))
    probes, _, _ = simhash.golay_keys(b.view(np.int64))
    index = defaultdict(set)
    for k, r in zip(keys.tolist(), rows.tolist(), strict=True):
        index[r].add(k)
    assert all(index[r] & set(probes[r].tolist()) for r in range(500))
    assert (simhash._errors() >= 0).sum(1).max() == 6


def test_golay_keys_for_every_place_of_three_errors():
    x = np.array([0x9E3779B97F4A7C15], np.uint64)
    _, keys, _ = simhash.golay_keys(x.view(np.int64))
    flips = [sum(1 << p for p in places) for n in range(4) for places in combinations(range(64), n)]
    probes, _, _ = simhash.golay_keys((x ^ np.array(flips, np.uint64)).view(np.int64))
    assert np.isin(probes, keys).any(1).all()


def test_golay_keys_of_unlike_fingerprints_rarely_meet():
    fp = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    probes, keys, rows = simhash.golay_keys(fp)
    order = np.argsort(keys)
    flat = probes.ravel()
    met = np.searchsorted(keys[order], flat, side="right") - np.searchsorted(keys[order], flat, side="left")
    own = probes.shape[1] * len(fp)  # each meets itself under every key
    assert own <= met.sum() <= own + 100


def test_simhash_classes(spark, docs):
    import xxhash

    def brute(text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = words(w)
        sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    base = " ".join(f"w{k * k % 97}" for k in range(400))
    extra = [(200 + k, base + " tail" * k) for k in range(6)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    fp = {i: brute(t) for i, t in texts.items()}
    comp = {i: i for i in fp}
    for _ in range(len(fp)):
        comp = {i: min(comp[j] for j in fp if bin(fp[i] ^ fp[j]).count("1") <= 3) for i in fp}
    got = simhash.classes(df.withColumn("first", F.lit("x"))).collect()
    assert len(got) == df.count() and {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got} == {i: (fp[i], comp[i]) for i in fp}
    assert simhash.classes(df.limit(0)).count() == 0


def brute_near(rows):
    """The smallest id of each id's class by Jaccard >= 0.8 of five-word shingles."""
    def shingles(text):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([" ".join(w)])

    sets = {i: shingles(t) for i, t in rows}
    by_word = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by_word[x].add(i)
    near = {i: {j for j in set().union(*(by_word[x] for x in s)) if 5 * len(s & sets[j]) >= 4 * len(s | sets[j])} for i, s in sets.items()}
    comp = {i: i for i in sets}
    while True:
        new = {i: min(comp[j] for j in near[i]) for i in comp}
        if new == comp:
            return comp
        comp = new


def test_near_classes_of_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_near([(r["doc_id"], r["text"]) for r in df.collect()])
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(df).collect()}
    linked = [i for i in want if want[i] != i]
    assert len(linked) > 20 and sum(got[i] == want[i] for i in linked) >= 0.99 * len(linked)
    assert all(want[i] == want[c] for i, c in got.items())  # nothing unlike is linked


def test_near_classes_leave_out_no_pair_that_meets_only_behind_others(spark):
    """Each key of two similar texts has an unlike text of a smaller node in front."""
    import xxhash

    rng = np.random.default_rng(7)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    node = lambda text: signed(xxhash.xxh64_intdigest(text.encode()))
    while True:
        w = [f"w{k}" for k in rng.integers(0, 10**6, 60)]
        v = [*w[:30], "other", *w[31:]]
        a, b = " ".join(w), " ".join(v)
        if min(node(a), node(b)) > 0 and bin(simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).count("1") > 3:
            break
    texts, in_front = [a, b], min(node(a), node(b))
    for own in (w, v):
        for k in range(len(own) - 4):
            shingle = " ".join(own[k : k + 5])
            texts.append(next(t for t in (f"{shingle} x{n}" for n in range(10**6)) if node(t) < in_front))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0] == got[1] == 0 and got == brute_near(list(enumerate(texts)))


@pytest.mark.parametrize("group, orders", [(32, 4), (1, 4), (2, 2)])
def test_near_classes_equal_brute_force(spark, monkeypatch, group, orders):
    """Texts of few different shingles, so that keys are frequent and put last."""
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "ORDERS", orders)
    rng = np.random.default_rng(group)
    blocks = [[f"b{k}w{n}" for n in range(int(rng.integers(3, 12)))] for k in range(25)]
    texts = []
    for _ in range(60):
        own = [blocks[k] for k in rng.integers(0, len(blocks), int(rng.integers(2, 9)))]
        for _ in range(3):
            w = [x for block in own for x in block]
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(0, len(w)))] = f"r{rng.integers(0, 1000)}"
            texts.append(" ".join(w[: len(w) - int(rng.integers(0, 4))]))
    want = brute_near(list(enumerate(texts)))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) < len(texts) - 10


def test_near_classes_in_parts_leave_no_tables(spark, tmp_path, monkeypatch):
    """Sets are put in a new order in parts; what was written on the way goes."""
    monkeypatch.setattr(simhash, "GROUP", 1)
    monkeypatch.setattr(simhash, "MANY_SETS", 1)
    monkeypatch.setattr("obsflow.llm.common.shared_dir", lambda spark: f"file://{tmp_path}")
    made = []
    monkeypatch.setattr(simhash, "written", lambda df, label, **kw: (made.append(label), common.written(df, label, **kw))[1])
    texts = [" ".join(f"b{k % 7}w{n}" for n in range(30)) + f" r{k % 3} tail" * (k % 4) for k in range(40)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_near(rows) and made.count("prefixes") % simhash.PARTS == 0 < made.count("prefixes")
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir() if p.is_dir()}
    assert not left & {"sketches", "sketched-ids", "sketch-nodes", "candidates", "first-classes", "shingle-sets", "first-documents", "prefixes", "similar"} and "near-classes" in left


def test_prefixes_hold_a_member_of_every_similar_set():
    for n in range(1, 400):
        for m in range(n, 2 * n):
            least = min(c for c in range(n + 1) if c * 1.0 / (n + m - c) >= 0.8) if 5 * n >= 4 * m else None
            assert least is None or (n - least + 1 <= simhash.prefix(n, 0.8) and m - least + 1 <= simhash.prefix(m, 0.8) and 5 * least >= 4 * (n + m - least))


def test_near_dedup_of_odd_rows(spark, docs):
    kept = simhash.filter_documents(docs)
    comp = brute_near(list(enumerate(TEXTS)))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp.values()))
    rows = [(None, "a b"), (None, "a b"), (3, "other words"), (3, "other words"), (2, "Other  WORDS")]
    got = simhash.filter_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == [(0, "a b"), (0, "a b"), (2, "Other  WORDS")]
    assert simhash.filter_documents(docs.limit(0)).count() == 0
