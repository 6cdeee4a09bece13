"""Language identification by cross-parsing entropy.

One suffix automaton per language holds every substring of that language's training text.  A document is parsed
greedily: the longest match from the current letter is one phrase, then the next begins.  The language that needs
the fewest phrases per letter wins (ties: the first by code point); score is 1 minus the ratio of its phrases to
the runner-up's (1 with a single language).

Letters are lower-cased; every run of other characters is one gap.  A letter that no training text has is a phrase
of its own.  Whole texts are parsed, in blocks of ``BLOCK`` letters side by side so that memory stays bounded.  A block
begins in the state its predecessor ends in: it is parsed from the start state first, then again from that state
until both parses are in the same state, from where on they agree.  So the phrases are those of the whole text.

Training text is a bounded sample of labelled rows, whole texts in the order of a seeded hash: at most ``ROWS`` rows and
``CHARS`` characters a language, among rows of at most ``LONGEST`` characters (a language without such rows: its
shortest ones, one at least).

Null texts and texts without a letter, and all texts if nothing was learned, are ``und`` with score 0.  Repeated rows get
the same answer each; columns not asked for, extra ones among them, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import below, fold, seeded, table, text_key

ROWS, CHARS, LONGEST, BLOCK = 64, 49_152, 16_384, 512
FEW = 32  # so many lanes or fewer go letter by letter
UNKNOWN = "und"


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of non-letters as one space."""
    cp = tv.code_points(text.lower())
    return tv.gaps_joined(cp, tv.letter_flags()[cp])


def suffix_automaton(symbols: np.ndarray, alphabet: int, room: np.ndarray | None = None) -> np.ndarray:
    """Transitions (state x symbol) of the automaton of all substrings; 0 is the start, -1 no transition.

    They are written to the first rows of ``room`` (2 * symbols + 1 states at most, rows not set before); others stay untouched."""
    nxt = np.empty((2 * len(symbols) + 1, alphabet), dtype=np.int32) if room is None else room
    nxt[0] = -1
    link, length = [-1], [0]
    last, n = 0, 1
    for c in symbols.tolist():
        cur, n = n, n + 1
        nxt[cur] = -1
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and nxt[p, c] < 0:
            nxt[p, c] = cur
            p = link[p]
        if p >= 0:
            q = int(nxt[p, c])
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin, n = n, n + 1
                nxt[twin] = nxt[q]
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p, c] == q:
                    nxt[p, c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt[:n]


@functools.lru_cache(maxsize=1)
def _build(training: tuple[tuple[str, str], ...]) -> tuple[list[str], np.ndarray, np.ndarray, list[int]]:
    """Languages, code point -> symbol (0: in no training text), all transitions in one table, start rows."""
    texts = [letters(t) for _, t in training]
    known = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint32)
    symbol = np.zeros(0x110000, dtype=np.uint16)
    symbol[known] = np.arange(1, len(known) + 1)
    width = len(known) + 1
    # every automaton is built at its place in one table; rows that no state takes are never touched and cost nothing
    steps = np.empty((sum(2 * len(t) + 1 for t in texts), width), dtype=np.int32)
    starts, at = [], 0
    for t in texts:
        own = suffix_automaton(symbol[t], width, steps[at:])
        np.add(own, at, out=own, where=own >= 0)
        starts.append(at)
        at += len(own)
    return [lang for lang, _ in training], symbol, steps[:at], starts


def _step(state: np.ndarray, symbols: np.ndarray, steps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States after one more symbol, the lanes whose phrase ended before it, and how many phrases ended there."""
    to = steps.reshape(-1)[state * np.int64(steps.shape[1]) + symbols]
    where = np.flatnonzero(to < 0)
    again = steps[start][symbols[where]]
    to[where] = np.where(again < 0, start, again)
    return to, where, (state[where] != start).astype(np.int32) + (again < 0)  # an unknown letter is a phrase by itself


def _meet(symbols: list[int], old: int, new: int, steps: np.ndarray, start: int) -> tuple[int, int | None]:
    """Two parses of one lane, letter by letter until they agree: phrases of ``new`` less those of ``old``, and the last
    state of ``new`` (None if they met)."""
    width, at = steps.shape[1], steps.reshape(-1).item
    more = 0
    for c in symbols:
        a, b = at(old * width + c), at(new * width + c)
        if a < 0:
            more -= old != start
            a = at(start * width + c)
            if a < 0:
                more -= 1
                a = start
        if b < 0:
            more += new != start
            b = at(start * width + c)
            if b < 0:
                more += 1
                b = start
        if a == b:
            return more, None
        old, new = a, b
    return more, new


def phrases(lanes: np.ndarray, lengths: np.ndarray, steps: np.ndarray, start: int, before: np.ndarray | None = None) -> np.ndarray:
    """Greedy phrases of each lane (rows of symbols, longest first) under one language.

    ``before`` names the lane that a lane goes on from (-1: it begins a text); a phrase counts in the lane where it ends."""
    n = len(lanes)
    before = np.full(n, -1) if before is None else before
    end = np.full(n, start, dtype=np.int32)
    count = np.zeros(n, dtype=np.int32)
    alive = np.searchsorted(-lengths, -np.arange(lanes.shape[1]), side="left")  # lanes longer than each position
    for i, k in enumerate(alive):
        end[:k], where, ended = _step(end[:k], lanes[:k, i], steps, start)
        count[where] += ended
    entry = np.full(n, start, dtype=np.int32)
    while True:  # parse lanes again whose predecessor ends elsewhere than they began, until both parses agree
        want = np.where(before >= 0, end[before], start)
        live = np.flatnonzero(want != entry)
        if not len(live):
            break
        old, new = entry[live], want[live]
        entry[live] = new
        for i in range(lanes.shape[1]):
            inside = lengths[live] > i
            if not inside.all():
                end[live[~inside]] = new[~inside]
                live, old, new = live[inside], old[inside], new[inside]
            if len(live) <= FEW:
                for row, x, y in zip(live.tolist(), old.tolist(), new.tolist()):
                    more, last = _meet(lanes[row, i:lengths[row]].tolist(), x, y, steps, start)
                    count[row] += more
                    end[row] = end[row] if last is None else last
                live, new = live[:0], new[:0]
                break
            symbols = lanes[live, i]
            old, where, ended = _step(old, symbols, steps, start)
            count[live[where]] -= ended
            new, where, ended = _step(new, symbols, steps, start)
            count[live[where]] += ended
            apart = old != new
            live, old, new = live[apart], old[apart], new[apart]
        end[live] = new
    last = np.ones(n, dtype=bool)
    last[before[before >= 0]] = False
    return count + (last & (end != start))


def identify(texts: list[str | None], training: tuple[tuple[str, str], ...]) -> tuple[list[str], list[float]]:
    if not training:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    langs, symbol, steps, starts = _build(training)
    own, owner, first = [], [], []
    has = np.zeros(len(texts), dtype=bool)
    for i, t in enumerate(texts):
        cp = letters(t) if t else np.zeros(0, np.uint32)
        if len(cp) and tv.base_letter_flags()[cp].any():  # marks alone are no letters
            has[i] = True
            sym = symbol[cp]
            n = -(-len(sym) // BLOCK)
            own += np.array_split(sym, n)
            owner += [i] * n
            first += [True] + [False] * (n - 1)
    counts = np.zeros((len(texts), len(langs)))
    if own:
        lengths = np.array([len(b) for b in own])
        order = np.argsort(-lengths, kind="stable")
        lanes = np.zeros((len(own), lengths.max()), dtype=np.uint16, order="F")
        for at, j in enumerate(order):
            lanes[at, :lengths[j]] = own[j]
        row = np.empty(len(order), dtype=np.int64)
        row[order] = np.arange(len(order))
        before = np.where(np.array(first), -1, np.roll(row, 1))[order]
        owners, lengths = np.array(owner)[order], lengths[order]
        for k, start in enumerate(starts):
            counts[:, k] = np.bincount(owners, weights=phrases(lanes, lengths, steps, start, before), minlength=len(texts))
    best = counts.argmin(axis=1)
    ranked = np.sort(counts, axis=1)
    score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1) if len(langs) > 1 else np.ones(len(texts))
    return [langs[b] if h else UNKNOWN for b, h in zip(best, has)], np.where(has, score, 0.0).tolist()


def learn(docs: DataFrame, rows: int = ROWS, chars: int = CHARS, longest: int = LONGEST) -> tuple[tuple[str, str], ...]:
    """Bounded training text of each language, whole texts of rows whose crc32(doc_id) mod 3 is not 1."""
    size = F.length("text")
    known = docs.where((fold("doc_id", 3) != 1) & F.col("lang").isNotNull() & (size > 0))
    stats = known.groupBy("lang").agg(F.count(F.when(size <= longest, 1)).alias("n"), F.min(size).alias("least")).collect()
    if not stats:
        return ()

    def by_language(values: dict) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("lang"))

    key = seeded("doc_id", "lang-1")
    some = known.where(size <= by_language({r["lang"]: max(longest, r["least"]) for r in stats}))
    # order a few of a frequent language's rows only
    some = some.where(below(key, by_language({r["lang"]: min(1.0, 4.0 * rows / max(1, r["n"])) for r in stats})))
    order = Window.partitionBy("lang").orderBy("key", "doc_id", "text")
    picked = (some.select("lang", "doc_id", key.alias("key"), "text").withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows)
              .withColumn("upto", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .where((F.col("upto") <= chars) | (F.col("r") == 1))
              .groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "text"))), lambda v: v["text"]), "\n").alias("t")))
    return tuple((r["lang"], r["t"]) for r in picked.orderBy("lang").collect())


def predict(docs: DataFrame, training: tuple[tuple[str, str], ...], keep: list[str], out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``docs`` with the language and its score, named as ``out``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text"):
                lang, score = identify(part.column("text").to_pylist(), training)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(lang), pa.array(score, pa.float64())], names=[*keep, *out])
        _build.cache_clear()  # the worker goes on to other stages
        tv.release()

    fields = docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{out[0]} string", f"{out[1]} double"])
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def rejected(docs: DataFrame, training: tuple[tuple[str, str], ...]) -> DataFrame:
    """doc_id and ``tie`` (text hash) of the documents without a language: only ids and texts go to the workers, only these come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tv.slices(batch, "text"):
                lang, _ = identify(part.column("text").to_pylist(), training)
                yield part.select(["doc_id", "tie"]).filter(pa.array([x == UNKNOWN for x in lang], pa.bool_()))
        _build.cache_clear()
        tv.release()

    rows = docs.select("doc_id", text_key().alias("tie"), "text")
    return rows.mapInArrow(run, rows.drop("text").schema).distinct()


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs), ["doc_id"]).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
