"""The pipeline's stages on a small corpus, each on its own input."""

import collections
import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, words):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    words = [a + b for a in ("lo", "mi", "ra", "te", "un") for b in ("na", "ver", "st", "co", "pi", "ga")]
    passage = prose(1, 40, words)
    rows = [(i, prose(100 + i, 60 + i % 50, words), "en", f"s{i % 4}") for i in range(120)]
    copy = rows[10][1].split()
    copy[5] = "changed"
    rows += [(200, rows[3][1], "en", "s0"), (201, " ".join(copy), "en", "s1"), (202, f"{prose(9, 30, words)} {passage} {prose(8, 30, words)}", "en", "s2"),
             (203, None, "en", "s0"), (204, "12 34", "en", None), (205, "", None, "s1"), (206, prose(7, 50, words), None, None)]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages_take_effect(spark, corpus):
    import corpus_pipeline as p
    from raretide.llm.common import written
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES[:-1]:
        docs = written(stage(spark, docs, corpus), name)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
        kept[name] = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    everyone = set(range(120)) | set(range(200, 207))
    assert set(kept["language_id"]) == everyone - {203, 204, 205}
    assert set(kept["near_duplicates"]) == everyone - {203, 204, 205, 200, 201}
    assert set(kept["decontamination"]) == everyone - {203, 204, 205, 200, 201, 202}
    assert set(kept["mixing"]) <= set(kept["decontamination"]) and max(kept["mixing"].values()) <= 2
    out = p.run(spark, corpus)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == sum(kept["mixing"].values())


def test_clashing_columns_and_odd_rows(spark, corpus):
    """Extra columns keep their values, whatever their names; repeated rows and nulls don't break a stage."""
    import corpus_pipeline as p
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 5")).unionByName(docs.where("doc_id = 50").withColumn("doc_id", F.lit(None).cast("long")))
    extra = ["lang_pred", "score", "tie", "row", "n", "piece", "text_", "size", "repeats", "key", "label", "x"]
    docs = docs.withColumns({c: F.col("doc_id") for c in extra})
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.columns == docs.columns
        assert out.where(" OR ".join(f"NOT ({c} <=> doc_id)" for c in extra)).count() == 0 and out.count() > 50, name
    assert p.STAGES[-1][1](spark, docs, corpus).count() == docs.count()


def test_without_a_known_language_texts_with_letters_stay(spark, corpus):
    import corpus_pipeline as p
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{corpus}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    kept = {r["doc_id"] for r in p.language(spark, docs, corpus).select("doc_id").collect()}
    assert kept == (set(range(120)) | set(range(200, 207))) - {203, 204, 205}


def test_an_empty_table_stays_empty(spark, corpus):
    import corpus_pipeline as p
    none = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in p.STAGES:
        assert stage(spark, none, corpus).count() == 0, name


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
