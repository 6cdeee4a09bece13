"""Operators 11 to 13 on small tables, against brute force, the tokenizers library and SQL, with every odd case of the input."""

import collections
import hashlib
import itertools
import math
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, ids string, row long, leaf int, score double, q long, c string"
WORDS = ["alpha", "beta", "gamma", "delta", "don't", "zeta", "we'll", "theta", "ñandú", "東京", "x1y2", "…", "--", "\n", "\t", "  ", "'"]


def prose(seed, n, words=WORDS):
    r = random.Random(seed)
    return "".join(r.choice(words) + r.choice([" ", " ", "", ", ", ". ", "\n\n", "   "]) for _ in range(n))


def docs_frame(spark, rows):
    """Documents with extra columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, "x", 7, 1, 0.5, 3, "y") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd():
    return [(0, None), (1, ""), (2, "  \n\t "), (3, "one"), (4, "Two words <|endoftext|> and<|endoftext|>"), (5, prose(5, 6000)), (6, prose(1, 300)), (6, prose(1, 300)),
            (7, prose(2, 40)), (7, prose(3, 40)), (None, prose(4, 50)), (None, None), (8, "x" * 40_000), (9, "東京" * 9000), (10, "ab1" * 15_000), (11, " " * 40_000 + "a"),
            (12, "'ll" * 14_000), (13, "a" + "<|endoftext|>" * 3000)]


# ---------------------------------------------------------------- 11 encoding and decoding

@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    from raretide.llm import op11_bpe_codec as o
    return Tokenizer.from_file(o.vocabulary_path())


def test_codec_equals_the_library(spark, odd, library, monkeypatch):
    from raretide.llm import op11_bpe_codec as o
    path = o.vocabulary_path()
    got = o.decode(o.encode(docs_frame(spark, odd), path), path)
    assert got.columns == ["doc_id", "ids", "text"]
    key = lambda i, ids, t: (i is None, i or 0, tuple(ids), t)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in odd]
    assert sorted(key(r["doc_id"], r["ids"], r["text"]) for r in got.collect()) == sorted(key(i, ids, library.decode(ids, skip_special_tokens=False)) for i, ids in want)
    assert o.decode(o.encode(docs_frame(spark, []), path), path).count() == 0


def test_tree_of_small_leaves_equals_the_library(odd, library, monkeypatch):
    """Cut everywhere: leaves of 1 to 40 code points, joined up the tree."""
    from raretide.llm import op11_bpe_codec as o
    own = o.codec(o.vocabulary_path())
    r = random.Random(3)
    alphabets = ["ab", "a b'", "don't 'll ve\n", "ñ東 　\xa0a", "1a! ", "\x1c\x0b\x85 a", "the quick brown"]
    texts = [(t or "")[:3000] for _, t in odd] + ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randrange(300))) for _ in range(150)]
    texts += ["".join(r.choice(a) for _ in range(200)) for a in alphabets for _ in range(8)]
    for text in texts:
        monkeypatch.setattr(o, "LEAF", r.choice([1, 2, 3, 7, 16, 40]))
        monkeypatch.setattr(o, "WINDOW", r.choice([1, 2, 8]))
        tree = o.Tree(own)
        for s in own.segments(text):
            for k, part in enumerate(o.halves(s)):
                tree.add(np.array(own.encode(part), dtype=np.int64), k == 0)
        assert tree.ids().tolist() == library.encode(text, add_special_tokens=False).ids, text[:200]


def test_windows_stay_small_where_ids_agree(monkeypatch):
    """Joining two halves of a long unsplit text encodes a few bytes around the join again, not the halves."""
    from raretide.llm import op11_bpe_codec as o
    own = o.codec(o.vocabulary_path())
    r = random.Random(9)
    text = "".join(r.choice("abcdefghijklmnop") for _ in range(20_000))
    parts = [np.array(own.encode(t), dtype=np.int64) for t in (text[:10_000], text[10_000:])]
    seen = []

    class Core:
        def encode_single_piece(self, raw):
            seen.append(len(raw))
            return own.core.encode_single_piece(raw)

    probe = o.Codec.__new__(o.Codec)
    probe.__dict__.update(own.__dict__, core=Core())
    assert np.concatenate(o.join(probe, [parts[0]], [parts[1]])).tolist() == own.encode(text)
    assert sum(seen) < 500


# ---------------------------------------------------------------- 12 conversation repair

CONV = "conv_id long, turn long, role string, text string, c string, n long, h string, audit string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, "h", "K") for r in rows], CONV)


def faults_of(rows):
    """(role, text, fault) of one conversation's rows, in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_repair(rows):
    """Every sequence of edits with at most two inserts at a place, without any merging."""
    best = None
    rows = faults_of(rows)
    gaps = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]

    def go(i, cost, audit, turns):
        nonlocal best
        for add in gaps:
            c, a, t = cost + 3 * len(add), audit + "I" * len(add), turns + [(x, "") for x in add]
            if best and c > best[0]:
                continue
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", "".join(x[0][:1] or "-" for x in t)):
                    best = min(best or (c, a, t), (c, a, t))
                continue
            role, text, fault = rows[i]
            go(i + 1, c + 4, a + "D", t)
            if fault not in ("blank", "duplicate"):
                left = c + (3 if fault == "truncated" else 0)
                go(i + 1, left, a + "K", t + [(role, text)])
                for x in ("user", "assistant"):
                    go(i + 1, left + 3, a + "R", t + [(x, text)])

    best = (4 * len(rows), "D" * len(rows), [])
    go(0, 0, "", [])
    return best


def odd_conversations():
    r = random.Random(4)
    rows = []
    for c in range(60):
        n = r.randrange(1, 5)
        for turn in range(n):
            rows.append((c, r.choice([turn, turn, turn + 1, None]), r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                         r.choice(["Yes.", "No!", "broken off", "", " \n", None, "Yes.", f"Line {turn}.", f"É {turn}? \t"])))
    return rows + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None)]


def ordered(rows):
    filled = [(t, " " if a is None else a, " " if b is None else b) for _, t, a, b in rows]
    return sorted(filled, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).hexdigest()))


@pytest.mark.parametrize("piece", [1, 2, 1000])
def test_repair_equals_all_edits_tried(spark, monkeypatch, piece):
    from raretide.llm import op12_conversation_repair as o
    monkeypatch.setattr(o, "PIECE", piece)
    rows = odd_conversations()
    df = conversations(spark, rows)
    by = collections.defaultdict(list)
    for x in rows:
        by[x[0]].append(x)
    got = {x["conv_id"]: x for x in o.report(df, o.rows_of(df)).collect()}
    assert set(got) == set(by)
    turns = collections.defaultdict(list)
    for x in o.repaired(df).orderBy("conv_id", "place").collect():
        turns[x["conv_id"]].append((x["role"], x["text"]))
    for c, own in by.items():
        own = ordered(own)
        cost, audit, repaired = brute_repair([x[1:] for x in own])
        f = collections.Counter(x[2] for x in faults_of([x[1:] for x in own]))
        known = [x[0] for x in own if x[0] is not None]
        initials = [x[1][:1] for x in own]
        x = got[c]
        assert (x["cost"], x["audit"]) == (cost, audit), own
        assert turns[c] == repaired and x["repaired_sha256"] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()
        assert (x["blank"], x["duplicate"], x["truncated"]) == (f["blank"], f["duplicate"], f["truncated"])
        assert x["gaps"] == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        assert x["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))


def test_repair_query_equals_sql(spark, tmp_path):
    from raretide.llm import op12_conversation_repair as o
    rows = odd_conversations() + [(100 + k, t, r, "Fine.") for k in range(200) for t, r in ((0, "user"), (1, "assistant"))]
    conversations(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = o.op12_conversation_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(o.SQL)
    assert [d[0] for d in want.description] == got.columns
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.fetchall()))


def test_a_long_conversation_is_parsed_in_pieces(spark, monkeypatch):
    """One conversation over many tasks, with repeated rows: the same as a single pass over it."""
    from raretide.llm import op12_conversation_repair as o
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice([f"T{t}.", "Same.", "open", ""])) for t in range(3000)] + [(1, 7, "user", "Again.")] * 400
    df = conversations(spark, rows)
    tops = {0: (0, "", o.STACKS[0])}
    own = faults_of([x[1:] for x in ordered(rows)])
    for role, _, fault in own:
        o.inserts(tops)
        tops = o.consume(tops, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    o.inserts(tops)
    want = min(x[:2] for x in tops.values() if o.accepts(x[2]))
    monkeypatch.setattr(o, "PIECE", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = o.report(df, o.rows_of(df)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(x["cost"], x["audit"]) for x in got] == [want]
    assert got[0]["duplicate"] == sum(x[2] == "duplicate" for x in own)


def test_repair_of_nothing(spark):
    from raretide.llm import op12_conversation_repair as o
    none = conversations(spark, [])
    assert o.report(none, o.rows_of(none)).count() == 0 and o.repaired(none).count() == 0
    one = conversations(spark, [(5, 0, "user", "a.")])
    x = o.report(one, o.rows_of(one.where("turn > 0"))).first()  # all its rows are lost
    assert (x["gaps"], x["illegal"], x["cost"], x["audit"], x["repaired_sha256"]) == (0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# ---------------------------------------------------------------- 13 lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=10):
    known = [(i, collections.Counter(terms(t))) for i, t in docs]
    known = [(i, c, sum(c.values())) for i, c in known if c]
    n_docs, n_terms = len(known), sum(n for *_, n in known)
    df = collections.Counter(t for _, c, _ in known for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in known:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank + 1, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def corpus(odd):
    r = random.Random(6)
    names = [f"w{int(r.paretovariate(0.7))}" for _ in range(4000)]
    docs = odd + [(100 + i, " ".join(r.choice(names) for _ in range(r.choice([3, 20, 200])))) for i in range(700)]
    docs += [(i, docs[30][1]) for i in range(900, 930)]  # copies: equal scores
    items = [(k, " ".join(r.choice(names) for _ in range(r.randrange(1, 30)))) for k in range(25)]
    return docs, items + [(50, None), (51, "..."), (52, "alpha 東京 X1Y2"), (52, "alpha"), (None, "w1 w2 w3"), (53, "nowhere"), (54, docs[30][1])]


@pytest.mark.parametrize("shard_words, block, rows", [(1 << 20, 64, 200_000), (500, 4, 60), (3000, 2, 200_000)])
def test_search_equals_all_scores(spark, corpus, monkeypatch, shard_words, block, rows):
    from raretide.llm import op13_lexical_search as o
    docs, items = corpus
    monkeypatch.setattr(o, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(o, "BLOCK", block)
    monkeypatch.setattr(o, "QUERY_ROWS", rows)
    queries = spark.createDataFrame([(i, t, 9, "z") for i, t in items], "item_id long, text string, rank int, term string")
    got = o.search(o.build_index(docs_frame(spark, docs)), queries).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(key, got)) == sorted(map(key, brute_search(docs, items)))


def test_search_skips_blocks_and_keeps_the_best(corpus):
    """Long lists next to a rare term: non-essential lists are decoded in part only."""
    from raretide.llm import op13_lexical_search as o
    import pyarrow as pa
    n = 20_000
    r = np.random.default_rng(1)
    counts = np.full(n, 6)
    words = r.integers(1, 4, (n, 6)).astype(np.uint64)
    words[r.choice(n, 12, replace=False), 0] = 99
    head, rows = o.shard_rows(0, pa.array(np.arange(n)), words.ravel(), counts, n, 6 * n)
    m = o.norms(counts, n, 6 * n)
    lists = {t: o.Postings(df, top, h, p, m) for t, df, top, h, p in zip(*(rows.column(c).to_pylist() for c in ("term", "df", "top", "heads", "payload")))}
    for t, p in lists.items():
        doc, impact = p.whole()
        tf = (words == t).sum(axis=1)
        assert (doc == np.flatnonzero(tf)).all() and (impact == o.impacts(tf[doc], m[doc])).all()
        p.all, p.decoded = None, 0
    asked = [(o.weight(n, p.df), p) for p in lists.values()]
    total = np.zeros(n, dtype=np.int64)
    for w, p in asked:
        doc, impact = p.whole()
        total[doc] += w * impact
        p.all, p.decoded = None, 0
    least = int(np.sort(total)[-10])
    docs, scores = o.best_of_shard(asked, n, least)
    assert set(docs.tolist()) == set(np.flatnonzero(total >= least).tolist()) and (scores == total[docs]).all()
    assert sum(p.decoded for p in lists.values()) < sum(len(p.heads) for p in lists.values()) / 5


def test_search_of_nothing(spark, corpus):
    from raretide.llm import op13_lexical_search as o
    docs, items = corpus
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert o.search(o.build_index(docs_frame(spark, [])), queries).count() == 0
    assert o.search(o.build_index(docs_frame(spark, docs[:40])), queries.limit(0)).count() == 0


def test_registered():
    import __spark_entry__ as entry
    assert {"op11_bpe_codec", "op12_conversation_repair", "op13_lexical_search"} <= set(entry.queries())
    assert {"op12_conversation_repair", "op13_lexical_search"} <= set(entry.oracle_sql())
