"""Toxicity by a weighted lexicon, matched with one Aho-Corasick automaton per worker.

Folding: Unicode compatibility forms, lower case, accents kept, homoglyphs and digit or sign substitutions
mapped to the letters they imitate (``l`` and ``i`` share a form, as ``1`` stands for either), everything that is
not a letter becomes one space.  Lexicon, exceptions and texts are folded alike.

Lexicon: whole words and word beginnings, with their log-odds of toxic over clean documents in a bounded sample of
labelled training rows (``SAMPLE`` rows of each label, lowest seeded hashes), kept where the log-likelihood ratio is beyond chance for so many
terms and they explain toxic rows that stronger terms do not, or are as frequent and exclusive.  Exceptions: phrases of a lexicon
word and a neighbour that clean documents use and toxic ones do not; a hit inside one counts nothing.

Score: the sum of the strongest hit of each word, over 1 + log(1 + words / 100) / 4, through a logistic curve fitted
on the same sample.  Null and empty texts have no hit and get the curve's value at 0, below 0.5.  Without toxic
or clean training rows there is no lexicon and every score is 0.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import broadcast_up_to, fold, lowest, table, written

SAMPLE = 4000
MIN_WEIGHT = 2.0
PREFIXES = range(4, 8)

# Characters that imitate a Latin letter (Cyrillic, Greek, signs), and digits.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "ԁ": "d", "ո": "n", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e", "ω": "w", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i",
}
SIGNS = {"@": "a", "$": "s"}



@functools.lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """What each code point becomes: its lower-case letter, the letter it imitates, or 0 for a gap."""
    out = np.where(tv.letter_flags(), np.arange(0x110000, dtype=np.uint32), 0).astype(np.uint32)
    for cp in np.flatnonzero(out):
        low = chr(cp).lower()
        out[cp] = ord(low) if len(low) == 1 else cp
    for look, letter in HOMOGLYPHS.items():
        for form in {look, look.upper()}:
            if len(form) == 1:
                out[ord(form)] = ord(letter)
    return out


def folded(text: str | None) -> str:
    """Folded words joined, led and ended by single spaces."""
    s = text or ""
    if not s.isascii() and not unicodedata.is_normalized("NFKC", s):
        s = unicodedata.normalize("NFKC", s)
    cp = tv.code_points(s)
    out = _fold_table()[cp]
    for sign, letter in SIGNS.items():
        if sign in s:  # only where a letter follows
            at = np.flatnonzero(cp[:-1] == ord(sign))
            out[at[out[at + 1] > 0]] = ord(letter)
    words = tv.gaps_joined(out, out > 0).tobytes().decode("utf-32-le", "surrogatepass").rstrip()
    return f" {words} " if words else " "


def _forms(word: str) -> Iterator[str]:
    yield f" {word} "
    for n in PREFIXES:
        if n < len(word):
            yield f" {word[:n]}"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: documents of either label that hold each term."""
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            terms = {t for w in set(folded(text).split()) for t in _forms(w)}
            counts[toxic].update(terms)
        for label, c in counts.items():
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(c), pa.string()), "n_toxic": pa.array([n * label for n in c.values()], pa.int64()),
                                              "n_clean": pa.array([n * (1 - label) for n in c.values()], pa.int64())})


@functools.lru_cache(maxsize=2)
def _automaton(terms: tuple[tuple[str, float], ...]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for term, weight in terms:
        a.add_word(term, (len(term), weight))
    if terms:
        a.make_automaton()
    return a


def hits(text: str, terms: tuple[tuple[str, float], ...]) -> dict[int, float]:
    """Start of each word hit in a folded text, with its strongest weight."""
    found: dict[int, float] = {}
    if terms:
        for end, (n, weight) in _automaton(terms).iter(text):
            at = end - n + 1
            if weight > found.get(at, 0.0):
                found[at] = weight
    return found


def _phrases(text: str, at: int) -> tuple[str, str]:
    """The word hit with the word before it, and with the one after it."""
    end = text.find(" ", at + 1)
    before = text.rfind(" ", 0, at) if at else -1
    after = text.find(" ", end + 1) if end >= 0 else -1
    return (text[before:end + 1] if before >= 0 else ""), (text[at:after + 1] if after >= 0 else "")


def strength(text: str | None, terms: tuple, exceptions: frozenset[str]) -> float:
    s = folded(text)
    found = hits(s, terms)
    if not found:
        return 0.0
    total = sum(w for at, w in found.items() if not (exceptions and exceptions.intersection(_phrases(s, at))))
    return total / (1 + math.log1p(s.count(" ") / 100) / 4)


def _map_strength(columns: list[str], terms: tuple, exceptions: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [strength(t, terms, exceptions) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(x, pa.float64())], names=columns + ["__x"])
    return run


def _map_phrases(terms: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                s = folded(text)
                found = sorted({p for at in hits(s, terms) for p in _phrases(s, at) if p})
                yield pa.RecordBatch.from_pydict({"phrase": pa.array(found, pa.string()), "toxic": pa.array([toxic] * len(found), pa.int32())})
    return run


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of at most ``per_label`` training rows of each label; training rows are those whose
    crc32(doc_id) mod 5 is not 0."""
    rows = labels.where((fold("doc_id", 5) != 0) & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = None
    for label in (0, 1):
        part = lowest(rows.where(F.col("toxic") == label), "toxic-1", per_label)
        picked = part if picked is None else picked.unionByName(part)
    picked = broadcast_up_to(written(picked, "toxic-ids"), 2 * per_label)
    return written(docs.select("doc_id", "text").join(picked, "doc_id").select("text", "toxic"), "toxic-sample")


def learn(train: DataFrame, exceptions: frozenset[str] = frozenset()) -> dict:
    """Terms with weights, exception phrases and the logistic curve, from ``text, toxic`` rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    empty = {"terms": (), "exceptions": frozenset(), "slope": 0.0, "offset": None}
    if not n0 or not n1:
        return empty
    counts = train.mapInArrow(_count_terms, "term string, n_toxic long, n_clean long").groupBy("term").agg(
        F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    counts = written(counts, "toxic-terms")
    share1, share0 = F.col("n_toxic") / n1, F.col("n_clean") / n0
    overall = (F.col("n_toxic") + F.col("n_clean")) / (n1 + n0)
    weight = F.log((F.col("n_toxic") + 0.5) / (n1 + 1)) - F.log((F.col("n_clean") + 0.5) / (n0 + 1))
    # log-likelihood ratio, against what the strongest of so many unrelated terms would reach
    ratio = 2 * (F.col("n_toxic") * F.log(share1 / overall) + F.when(F.col("n_clean") > 0, F.col("n_clean") * F.log(share0 / overall)).otherwise(0.0))
    chance = 2 * math.log(1 + counts.count())
    best = (counts.where(F.col("n_toxic") > 0).withColumn("w", weight).withColumn("g", ratio)
            .where((F.col("w") >= MIN_WEIGHT) & (F.col("g") >= chance))
            .orderBy(F.desc("g"), "term").collect())  # no more than the bounded sample holds
    terms = _explaining(train, best, n1, n0, chance)
    if not terms:  # nothing tells the labels apart
        return empty
    phrases = (train.mapInArrow(_map_phrases(terms), "phrase string, toxic int").groupBy("phrase")
               .agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
               .where((F.col("n0") >= 2) & (F.col("n1") == 0)).collect())
    exceptions = exceptions | frozenset(r["phrase"] for r in phrases)
    scored = train.mapInArrow(_map_strength(["toxic"], terms, exceptions), "toxic int, __x double")
    data = VectorAssembler(inputCols=["__x"], outputCol="features").transform(
        scored.withColumn("weight", F.when(F.col("toxic") == 1, 0.5 / n1).otherwise(0.5 / n0) * (n0 + n1)))
    fitted = LogisticRegression(labelCol="toxic", weightCol="weight", regParam=1e-4, standardization=True).fit(data)
    return {"terms": terms, "exceptions": exceptions, "slope": float(fitted.coefficients[0]), "offset": float(fitted.intercept)}


def _explaining(train: DataFrame, candidates: list, n1: int, n0: int, chance: float) -> tuple[tuple[str, float], ...]:
    """The candidates that explain toxic documents which no better one has explained, and their equals.

    Words of a text that was copied under a toxic label look toxic too, but add no document of their own.  The
    incidence of candidates in the bounded sample's toxic rows is all that comes to the driver."""
    if not candidates:
        return ()
    names = [r["term"] for r in candidates]
    number = {t: i for i, t in enumerate(names)}

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted({number[f] for w in set(folded(t).split()) for f in _forms(w) if f in number}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"terms": pa.array(rows, pa.list_(pa.int32()))})

    rows = train.where("toxic = 1").select("text").mapInArrow(incidence, "terms array<int>").collect()
    doc = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
    term = np.array([t for r in rows for t in r["terms"]], dtype=np.int64)
    clean = np.array([r["n_clean"] for r in candidates], dtype=float)
    toxic = np.array([r["n_toxic"] for r in candidates], dtype=float)
    length = np.array([len(t) for t in names])
    weight = np.array([r["w"] for r in candidates])
    open_ = np.ones(len(rows), dtype=bool)
    chosen: list[int] = []
    while True:
        n = np.bincount(term[open_[doc]], minlength=len(names)).astype(float)
        overall = (n + clean) / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 2 * (np.where(n > 0, n * np.log(n / n1 / overall), 0) + np.where(clean > 0, clean * np.log(clean / n0 / overall), 0))
        gain[n / n1 <= clean / n0] = 0
        best = np.lexsort((np.arange(len(names)), -length, -gain))[0]
        if gain[best] < chance:
            break
        chosen.append(int(best))
        open_[doc[term == best]] = False
    if not chosen:
        return ()
    alike = (toxic >= 0.5 * toxic[chosen].min()) & (weight >= weight[chosen].min() - 0.5)
    return tuple((names[i], float(weight[i])) for i in sorted({*chosen, *np.flatnonzero(alike).tolist()}))


def score(docs: DataFrame, model: dict, keep: list[str], out: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and the score, named ``out``."""
    fields = docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["__x double"])
    found = docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(_map_strength(keep, model["terms"], model["exceptions"]), schema)
    if model["offset"] is None:
        return found.select(*keep, F.lit(0.0).alias(out))
    return found.select(*keep, (1 / (1 + F.exp(-(F.col("__x") * model["slope"] + model["offset"])))).alias(out))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(sample(docs, table(spark, sf_dir, "labels")))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
