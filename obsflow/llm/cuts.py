"""Texts to token ids, each distinct stretch of text encoded once a batch.

Byte-level tokenizers first match a splitting pattern and then merge inside
each match.  A single space or newline between two other characters always
begins a new match, so a batch of texts is cut there, in Arrow, and only cuts
not met lately are matched and encoded.  What is remembered stands in Arrow and
numpy arrays of a bounded size.  Texts in which white space stands beside white
space are cut by a slower expression; texts that hold one of the tokenizer's
added tokens are encoded whole by the tokenizer.
"""

from __future__ import annotations

import re
import weakref
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cuts remembered at most, some 50 bytes each; a bound on memory.
REMEMBERED = 800_000
#: White space, in a wide sense: texts with other than single ones take the slow way.
WIDE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

SPACE, NOTHING = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())


def ranges(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[begin[k]:begin[k] + size[k]] of all k, one after the other."""
    ends = np.cumsum(size)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]


class Known:
    """Cuts and their ids: arrays of up to ``bound`` cuts.  When they are full,
    the cuts not asked for since the last time go first."""

    def __init__(self, bound: int = REMEMBERED):
        self.bound = bound
        self.clear()

    def clear(self) -> None:
        self.cuts = pa.array([], pa.large_string())
        self.ids, self.ends, self.used = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)

    def _keep(self, stay: np.ndarray) -> None:
        size = np.diff(self.ends)[stay]
        self.ids = ranges(self.ids, self.ends[:-1][stay], size)
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.cuts = self.cuts.filter(pa.array(stay))
        self.used = np.zeros(len(self.cuts), bool)

    def get(self, cuts: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each cut in ``cuts``, whose ids are ids[ends[k]:ends[k + 1]].
        encode: distinct cuts to (all ids, number of ids of each)."""
        if len(self.cuts) > self.bound // 2 and len(self.cuts) + len(cuts) > self.bound:
            self._keep(self.used)
            if len(self.cuts) + len(cuts) > self.bound:
                self.clear()
        found = pc.index_in(cuts, value_set=self.cuts)
        at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if found.null_count:
            missing = cuts.filter(found.is_null())
            fresh = missing.unique()
            ids, sizes = encode(fresh)
            at[found.is_null().to_numpy(zero_copy_only=False)] = len(self.cuts) + pc.index_in(missing, value_set=fresh).to_numpy()
            self.cuts = pa.concat_arrays([self.cuts, fresh])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
            self.used = np.concatenate([self.used, np.zeros(len(fresh), bool)])
        self.used[at] = True
        return at


#: The encoders of this worker.
_encoders: weakref.WeakSet = weakref.WeakSet()


def forget() -> None:
    """Empties what encoders remember.  Operators that need a worker's memory for
    something else call this first, since Spark reuses workers."""
    for e in _encoders:
        e.known.clear()


class CutEncoder:
    """encode: distinct matches of the pattern to the bytes of their 32-bit ids.

    The pattern must match letters, optionally after one space, by themselves.
    added: strings that the tokenizer takes out of a text before the pattern;
    whole: the bytes of the ids of a text that holds one.  joined: many cuts, each
    of one space or newline and other characters, to (all ids, ids of each).
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], list[bytes]], added: Sequence[str] = (), whole: Callable[[str], bytes] | None = None, joined: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None):
        import regex

        # White space as Unicode has it; Python's \s also takes four control characters.
        space = r"\p{White_Space}"
        self.match = regex.compile(pattern.replace(r"\S", rf"[^{space}]").replace(r"[^\s", rf"[^{space}").replace(r"\s", space)).findall
        self.slow = re.compile(r"(?<=[^\s])(?=[ \n][^\s])").split
        self.encode, self.added, self.whole, self.joined = encode, tuple(added), whole, joined
        self.known = Known()
        _encoders.add(self)

    def _learn(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct cuts, and their numbers."""
        if self.joined is None:
            return self._match(cuts)
        plain = pc.match_substring_regex(cuts, rf"^[ \n]{WIDE.replace('[', '[^', 1)}+$").to_numpy(zero_copy_only=False)
        pools = [self.joined(cuts.filter(pa.array(plain)).to_numpy(zero_copy_only=False).tolist()), self._match(cuts.filter(pa.array(~plain)))]
        order = np.argsort(np.concatenate([np.nonzero(plain)[0], np.nonzero(~plain)[0]]))
        size = np.concatenate([p[1] for p in pools])
        begin = np.cumsum(size) - size
        return ranges(np.concatenate([p[0] for p in pools]), begin[order], size[order]), size[order]

    def _match(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_learn``, through the pattern's matches.  Most cuts are letters,
        which are one match, or letters and a comma or stop, which are two."""
        letters = pc.match_substring_regex(cuts, r"^ ?\p{L}+$").to_numpy(zero_copy_only=False)
        stopped = pc.match_substring_regex(cuts, r"^ ?\p{L}+[,.]$").to_numpy(zero_copy_only=False)
        texts = cuts.to_numpy(zero_copy_only=False).tolist()
        matched = [[t] if one else [t[:-1], t[-1]] if two else self.match(t) for t, one, two in zip(texts, letters, stopped, strict=True)]
        flat = list(dict.fromkeys(m for ms in matched for m in ms))
        of = dict(zip(flat, self.encode(flat), strict=True))
        got = [of[ms[0]] if len(ms) == 1 else b"".join([of[m] for m in ms]) for ms in matched]
        return np.frombuffer(b"".join(got), np.int32), np.fromiter(map(len, got), np.int64, len(got)) // 4

    def _gather(self, cuts: pa.Array, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ends with a 0 in front) of cuts[code]."""
        at = self.known.get(cuts, self._learn)
        begin, size = self.known.ends[at], self.known.ends[at + 1] - self.known.ends[at]
        return ranges(self.known.ids, begin[code], size[code]), np.concatenate([[0], np.cumsum(size[code])])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's ids end, with a 0 in front); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        begin = parts.offsets.to_numpy()
        begin = begin - begin[0]
        coded = parts.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string())
        firsts, where = np.unique(code[begin[:-1]], return_inverse=True)
        code[begin[:-1]] = len(names) + where
        own = names.take(pa.array(firsts))
        cuts = pa.concat_arrays([pc.if_else(pc.starts_with(names, "\n"), names, pc.binary_join_element_wise(SPACE, names, NOTHING)), own])
        # A part that is empty or has white space at an end stood beside white space.
        odd = np.concatenate([_odd(names, False), _odd(own, True)])
        special = np.zeros(len(texts), bool)
        for token in self.added:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        slow = special | (np.add.reduceat(odd[code], begin[:-1]) > 0)
        if not slow.any():
            ids, ends = self._gather(cuts, code)
            return ids, ends[begin]
        # Slow texts leave the batch's codes and come back at their places.
        of_text = np.repeat(np.arange(len(texts)), np.diff(begin))
        fast = ~slow[of_text]
        ids, ends = self._gather(cuts if not odd.any() else pc.if_else(pa.array(odd), NOTHING, cuts), code[fast])
        counts = np.bincount(of_text[fast], weights=np.diff(ends), minlength=len(texts)).astype(np.int64)
        out = np.split(ids, np.cumsum(counts)[:-1])
        for k in np.nonzero(slow)[0]:
            out[k] = self._one(texts[int(k)].as_py(), bool(special[k]))
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def _one(self, text: str, special: bool) -> np.ndarray:
        if special:
            return np.frombuffer(self.whole(text), np.int32)
        cuts = pa.array(self.slow(text) if text else [], pa.large_string())
        coded = cuts.dictionary_encode()
        return self._gather(coded.dictionary, coded.indices.to_numpy().astype(np.int64))[0]


def _odd(parts: pa.Array, first: bool) -> np.ndarray:
    """Which parts are empty, or have white space at their end or, but for the
    newline that a part which isn't a text's first may begin with, at their start."""
    ends = pc.match_substring_regex(parts, rf"^$|{WIDE}$").to_numpy(zero_copy_only=False)
    starts = pc.match_substring_regex(parts, f"^{WIDE}" if first else r"^[\t\f\r\x0b\x1c-\x1f\x85\p{Z}]|^\n" + WIDE).to_numpy(zero_copy_only=False)
    return ends | starts
