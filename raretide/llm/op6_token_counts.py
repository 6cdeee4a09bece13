"""Token counts without token ids: each distinct pre-token is encoded once, and counts are summed per document.

A pre-token of the sentencepiece BPE vocabulary is a run of spaces with the word behind it: no piece holds a space
after another character (checked on loading), so merges never cross that border.  Where no piece holds a letter
or digit followed by ``. , ; : ! ?`` or a line feed, the marks behind a word are cut off too.

1. Every pre-token of the corpus is counted (per batch, then by shuffle) and encoded once: a written table.
2. The most frequent, at most ``TOP`` and so a bounded table, are sent to all tasks; a second pass sums them in place and keeps
   the rare rest of each document as (pre-token, frequency).
3. The rest is joined to the table.  Frequent pre-tokens, the hot keys, never reach that shuffle.

Null texts count as empty (0 tokens); repeated rows keep a row each; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raretide.llm.common import table, written

LIMIT, TOP, HELD = 4096, 200_000, 300_000
_MARKS = ".,;:!?\n"
# Text cut off behind a word is encoded behind this character, which no piece joins to anything.
_WALL = "\n"


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=1)
def _model(path: str):
    """The library's processor, and the marks that may be cut off behind an ASCII letter or digit."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    if any("▁" in p.lstrip("▁") or _WALL in p for p in pieces):
        raise ValueError("pieces of this vocabulary cross spaces; pre-tokens are not independent")
    if len(sp.encode(" ")) != 1:
        raise ValueError("two spaces are not one piece of this vocabulary")
    joined = {b for p in pieces for a, b in zip(p, p[1:]) if a.isascii() and a.isalnum()}
    return sp, "".join(m for m in _MARKS if m not in joined)


def spaced_parts(text: str) -> list[str]:
    """The text cut before each run of spaces; each part stands for one space more than it shows."""
    if "▁" in text:  # the vocabulary's own sign for a space
        text = text.replace("▁", " ")
    parts = text.split(" ") if text else []
    if "" not in parts:
        return parts
    out, run = [], 0
    for p in parts[:-1]:
        if p:
            out.append(" " * run + p)
            run = 0
        else:
            run += 1
    return [*out, " " * run + parts[-1]]


def keys(part: str, marks: str) -> list[str]:
    """Pre-tokens of a part.  One behind the wall, not behind a space, is led by the wall twice; no other has one."""
    head, *lines = part.split(_WALL)

    def words(text: str, lead: str) -> list[str]:
        bare = text.rstrip(marks)
        if bare and bare != text and bare[-1].isascii() and bare[-1].isalnum():
            return [lead + bare, 2 * _WALL + text[len(bare):]]
        return [lead + text]

    out = words(head, "") if head else [" "]  # a space alone is one piece, like two
    for line in lines:
        out.append(3 * _WALL)
        if line:
            out += words(line, 2 * _WALL)
    return out


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _ = _model(path)
        wall = len(sp.encode(_WALL))
        for batch in batches:
            names = batch.column("pre_token").to_pylist()
            cut = [t[:2] == 2 * _WALL for t in names]
            ids = sp.encode([t[1:] if c else t for t, c in zip(names, cut)], num_threads=1)
            n = [len(x) - wall if c else len(x) for x, c in zip(ids, cut)]
            yield pa.RecordBatch.from_arrays([batch.column("pre_token"), batch.column("n"), pa.array(n, pa.int64())], names=["pre_token", "n", "pieces"])
    return run


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, marks = _model(path)
        marks = marks.replace(_WALL, "")
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out: Counter = Counter()
            for part, n in held.items():
                for key in keys(part, marks):
                    out[key] += n
            held.clear()
            return pa.RecordBatch.from_pydict({"pre_token": pa.array(list(out), pa.string()), "n": pa.array(list(out.values()), pa.int64())})

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    held.update(spaced_parts(text))
                    if len(held) > HELD:
                        yield flush()
        if held:
            yield flush()
    return run


def _sum(path: str, frequent, columns: list[str]):
    """Pieces of the frequent pre-tokens of each text, and what is left to look up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, marks = _model(path)
        marks = marks.replace(_WALL, "")
        known: dict[str, int] = dict(frequent.value)
        parts_known = dict(known)
        room = len(parts_known) + HELD
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sums, rests = [], []
            for text in texts:
                parts = spaced_parts(text) if text else []
                n = list(map(parts_known.get, parts))
                total, rest = 0, Counter()
                if None in n:
                    for k, x in enumerate(n):
                        if x is not None:
                            continue
                        own, lost = 0, []
                        for key in keys(parts[k], marks):
                            m = known.get(key)
                            if m is None:
                                lost.append(key)
                            else:
                                own += m
                        n[k] = own
                        if lost:
                            rest.update(lost)
                        elif len(parts_known) < room:
                            parts_known[parts[k]] = own
                sums.append(sum(n))
                rests.append([{"pre_token": t, "freq": f} for t, f in rest.items()])
            kind = pa.list_(pa.struct([("pre_token", pa.string()), ("freq", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(sums, pa.int64()), pa.array(rests, kind)],
                names=[*columns, "n_bytes", "known", "rest"])
    return run


def piece_table(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct pre-token of the corpus: pre_token, n (occurrences), pieces."""
    counted = docs.select("text").mapInArrow(_count(path), "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return written(counted.mapInArrow(_encode(path), "pre_token string, n long, pieces long"), "pieces")


def _most_frequent(pieces: DataFrame, top: int) -> DataFrame:
    """At most ``top`` short pre-tokens: all from a frequency on.  A histogram of a few hundred rows gives that
    frequency, so the driver gets these rows and no candidates of every task."""
    short = pieces.where((F.length("pre_token") <= 64) & (F.col("n") > 1)).withColumn("step", F.floor(F.log("n") / math.log(1.1)).cast("int"))
    least, total = None, 0
    for step, n in short.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += n
        if total > top:
            break
        least = step
    return short.where(F.lit(False) if least is None else F.col("step") >= least).select("pre_token", "pieces")


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, top: int = TOP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each document's whole text."""
    spark = docs.sparkSession
    pieces = piece_table(docs, path)
    best = _most_frequent(pieces, top).collect()
    frequent = spark.sparkContext.broadcast({r[0]: r[1] for r in best})
    per_doc = docs.select("doc_id", "text").mapInArrow(
        _sum(path, frequent, ["doc_id"]), "doc_id long, n_bytes long, known long, rest array<struct<pre_token:string,freq:long>>")
    per_doc = written(per_doc.withColumn("row", F.monotonically_increasing_id()), "doc-pieces")
    rest = (per_doc.select("row", F.inline("rest")).join(pieces.select("pre_token", "pieces"), "pre_token")
            .groupBy("row").agg(F.sum(F.col("freq") * F.col("pieces")).alias("more")))
    total = F.col("known") + F.coalesce("more", F.lit(0))
    return per_doc.drop("rest").join(rest, "row", "left").select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())
