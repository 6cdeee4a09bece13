"""Token ids in binary files: one zstandard frame per document under a shared dictionary.

Tasks encode texts, append the end id, serialize the ids (little-endian unsigned 32-bit) and compress each document
by itself.  The dictionary is trained once on a bounded sample (``SAMPLE`` documents of lowest seeded hash, at
most ``SAMPLE_IDS`` ids of each).

Format, three Parquet tables under one folder, readable from any store Spark reads:
``dictionary`` (hash, bytes); ``data`` (piece, block, dictionary hash, payload: frames one after another, about
``BLOCK`` bytes); ``index`` (doc_id, piece, block, offset, length, local_start, n_tokens).  Pieces are ranges of
doc_id and documents are in ascending order in them, so a short document is read by one index row and one slice.

Null texts are empty: only the end id.  Repeated ids are in order of their texts' frames; documents without an id
come first in their piece.  An empty table gives empty tables.  Other columns are ignored.

Encoding: the byte-pair core over the vocabulary's own pattern (``op11_bpe_codec.Codec``) gives each whole text's ids as the
tokenizers library does; it keeps no cache.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from raretide.llm import textvec as tv
from raretide.llm.common import lowest, ordered_pieces, scratch_path, seeded, table
from raretide.llm.op11_bpe_codec import codec

END, SAMPLE, SAMPLE_IDS, DICTIONARY, LEVEL, BLOCK = 0, 1000, 1024, 1 << 16, 1, 2 << 20

def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _ids(path: str, texts: list[str]) -> list[bytes]:
    """Ids of each text, as little-endian bytes."""
    own = codec(path)
    return [np.array(own.encode(t), dtype="<u4").tobytes() for t in texts]


def train_dictionary(docs: DataFrame, path: str) -> tuple[str, bytes]:
    """Hash and bytes of the shared dictionary; the sample is one bounded partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        samples = []
        for batch in batches:
            samples += [ids[:4 * SAMPLE_IDS] for ids in _ids(path, _texts(batch)) if ids]
        try:
            trained = zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
        except zstandard.ZstdError:  # too few or too short samples: they are the dictionary's content themselves
            trained = b"".join(samples)[:DICTIONARY]
        yield pa.RecordBatch.from_pydict({"bytes": pa.array([trained], pa.binary())})

    # at most so many characters of a text, from a seeded place: not openings only
    room = F.greatest(F.length("text") - 16 * SAMPLE_IDS, F.lit(0))
    share = F.conv(F.substring(seeded("doc_id", "dictionary-2"), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    at = F.floor(share * (room + 1)).cast("int") + 1
    sample = lowest(docs.select("doc_id", F.substring("text", at, F.lit(16 * SAMPLE_IDS)).alias("text")), "dictionary-1", SAMPLE).coalesce(1)
    row = sample.mapInArrow(run, "bytes binary").first()
    raw = bytes(row["bytes"]) if row else b""
    return hashlib.sha256(raw).hexdigest(), raw


def _compress(path: str, raw: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        c = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            for part in tv.slices(batch, "text"):
                ids = [x + end for x in _ids(path, _texts(part))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([c.compress(x) for x in ids], pa.binary()),
                                                  pa.array([len(x) // 4 for x in ids], pa.int64())], names=["doc_id", "text", "n_tokens"])
        tv.release()  # the worker goes on to other stages
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frames of one piece in order -> blocks with their documents' offsets."""
    piece, block, start = None, 0, 0
    held: list[tuple] = []
    size = 0

    def out():
        offsets = np.cumsum([0, *(len(h[1]) for h in held)])
        docs = [{"doc_id": h[0], "offset": int(o), "length": len(h[1]), "local_start": h[3], "n_tokens": h[2]} for h, o in zip(held, offsets)]
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "offset", "length", "local_start", "n_tokens")]))
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([block], pa.int32()),
                                           pa.array([b"".join(h[1] for h in held)], pa.binary()), pa.array([docs], kind)],
                                          names=["piece", "block", "payload", "docs"])

    for batch in batches:
        for p, doc_id, frame, n in zip(*(batch.column(c).to_pylist() for c in ("piece", "doc_id", "text", "n_tokens"))):
            if held and (p != piece or size >= BLOCK):
                yield out()
                block, held, size = (block + 1 if p == piece else 0), [], 0
            if p != piece:
                piece, start = p, 0
            held.append((doc_id, frame, n, start))
            start += n
            size += len(frame)
    if held:
        yield out()


def write_tokens(docs: DataFrame, folder: str, path: str) -> None:
    """Encode every document and write the three tables under ``folder``."""
    spark = docs.sparkSession
    name, raw = train_dictionary(docs, path)
    spark.createDataFrame([(name, bytearray(raw))], "hash string, bytes binary").write.parquet(f"{folder}/dictionary")
    frames = docs.select("doc_id", "text").mapInArrow(_compress(path, raw), "doc_id long, text binary, n_tokens long")
    packed = ordered_pieces(frames, docs.select("doc_id")).mapInArrow(
        _pack, "piece int, block int, payload binary, docs array<struct<doc_id:long,offset:long,length:long,local_start:long,n_tokens:long>>")
    # offsets travel with the payload: one write, so data and index can't disagree
    packed.withColumn("dictionary", F.lit(name)).write.parquet(f"{folder}/data")
    spark.read.parquet(f"{folder}/data").select("piece", "block", F.inline("docs")).write.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 and the ids' bytes length checked."""
    dictionary = spark.read.parquet(f"{folder}/dictionary")
    name, raw = dictionary.first()
    raw = bytes(raw)
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError("the dictionary does not match its hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        for batch in batches:
            for piece, payload, used, docs in zip(*(batch.column(c).to_pylist() for c in ("piece", "payload", "dictionary", "docs"))):
                if used != name:
                    raise ValueError("data written under another dictionary")
                view = memoryview(payload)
                crc, n = [], []
                for x in docs:
                    ids = d.decompress(view[x["offset"]:x["offset"] + x["length"]])
                    crc.append(zlib.crc32(ids))
                    n.append(len(ids) // 4)
                yield pa.RecordBatch.from_pydict({
                    "piece": pa.array([piece] * len(docs), pa.int32()), "doc_id": pa.array([x["doc_id"] for x in docs], pa.int64()),
                    "local_start": pa.array([x["local_start"] for x in docs], pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64())})
        codec.cache_clear()  # all is encoded: the worker keeps no vocabulary
        tv.release()

    index = spark.read.parquet(f"{folder}/index")
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row a piece
    starts = index.groupBy("piece").agg(F.sum("n_tokens").alias("n")).select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("piece_start"))
    docs = spark.read.parquet(f"{folder}/data").select("piece", "payload", "dictionary", "docs").mapInArrow(
        run, "piece int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(starts), "piece").select("doc_id", (F.col("piece_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with its id, in order), the end id included: its index rows, the blocks they name, a slice of each."""
    rows = spark.read.parquet(f"{folder}/index").where(F.col("doc_id") == doc_id)
    blocks = spark.read.parquet(f"{folder}/data").select("piece", "block", "dictionary", "payload")
    found = rows.join(blocks, ["piece", "block"]).select(
        "piece", "local_start", "dictionary", F.expr("substring(payload, cast(offset AS int) + 1, cast(length AS int))").alias("frame")).orderBy("piece", "local_start").collect()
    name, raw = spark.read.parquet(f"{folder}/dictionary").first()
    import zstandard
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(raw)) if raw else None)
    if any(r["dictionary"] != name for r in found):
        raise ValueError("data written under another dictionary")
    return [np.frombuffer(d.decompress(bytes(r["frame"])), dtype="<u4") for r in found]


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary_path())
    return read_tokens(spark, folder)
