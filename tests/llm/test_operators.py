"""The ten operators on small tables, against brute force, with every odd case of the input."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, piece int, score double, row long, n long"
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "pi", "rho", "sigma", "tau", "phi", "chi"]


def docs_frame(spark, rows):
    """Documents with extra columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), "x", 7, 0.5, 3, 4) for i, t, lang, src in rows], DOCS)


def prose(seed, n, words=WORDS):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    long = prose(5, 60_000)
    rows = [(0, None, None, None), (1, "", "en", "a"), (2, "  \n\t ", "en", "b"), (3, "one", None, "a"), (4, "Two words", "en", None),
            (5, long, "en", "a"), (6, prose(1, 300), "en", "a"), (6, prose(1, 300), "en", "a"), (7, prose(1, 300), "de", "b"),
            (8, prose(2, 40), "en", "b"), (8, prose(3, 40), "en", "b"), (None, prose(4, 50), "en", "c"), (None, None, "en", "c"),
            (9, "ÀÉ größer niño 東京 \U0001F600 ок", "de", "c"), (10, "x" * 50_000, "en", "c"), (11, "0123 456 ... !!! $$$", "en", "c")]
    return docs_frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return docs_frame(spark, []).cache()


# ---------------------------------------------------------------- word and shingle hashes

def test_word_hashes_follow_the_pattern(monkeypatch):
    from raretide.llm import textvec as tv
    monkeypatch.setattr(tv, "SEGMENT", 64)  # many segments
    texts = ["", " a b", "Foo bar  foo", "é\x0bÉ x", prose(1, 200), "y" * 500, None, "a b"]
    data, offs = tv.buffers(pa.array(texts))
    hashes, counts = tv.word_hashes(data, offs, tv.SPACE_SEP)
    expected = [re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    flat = list(itertools.chain(*expected))
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(flat))
    for width in (1, 2, 5):
        sh, n = tv.shingle_hashes(hashes, counts, width)
        grams = [[tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else [] for w in expected]
        assert n.tolist() == [len(g) for g in grams]
        assert len({(h, g) for h, g in zip(sh.tolist(), itertools.chain(*grams))}) == len(set(itertools.chain(*grams))) == len(set(sh.tolist()))


def test_ordered_pieces_hold_every_row_once(spark):
    from raretide.llm.common import ordered_pieces
    ids = [*range(0, 900, 3), -5, 2 ** 62, 2 ** 62 + 1, None, None]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    got = ordered_pieces(df, halo=True).collect()
    own = [r for r in got if not r["halo"]]
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in own) == sorted((i is None, i) for i in ids)
    firsts = {p: min(r["doc_id"] for r in own if r["piece"] == p and r["doc_id"] is not None) for p in {r["piece"] for r in own if r["doc_id"] is not None}}
    order = [firsts[p] for p in sorted(firsts)]
    assert order == sorted(order) and len(order) > 1
    for r in got:
        if r["halo"]:
            assert r["doc_id"] == firsts[(r["piece"] + 1) % len(order)]


# ---------------------------------------------------------------- 1 fingerprints

def _op1_brute(rows):
    """Expected edited text by position in the order."""
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(known):
        s, nxt = t or "", known[(k + 1) % len(known)][1] or ""
        half = len(s) // 2
        out.append((i, s, s[:len(s) - half] + nxt[:half], nxt))
    return out + [(None, t or "", (t or "")[:len(t or "") - len(t or "") // 2], None) for i, t in rows if i is None]


def test_fingerprints_edit_and_compare(spark, odd):
    from raretide.llm import op1_fingerprints as o
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = o.edited_fingerprints(odd).collect()
    exp = _op1_brute(rows)
    key = lambda i, n, h: (i is None, i or 0, n, h)
    assert sorted(key(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(
        key(i, len(s), hashlib.sha256(e.encode()).hexdigest()) for i, s, e, _ in exp)
    prints = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    for i, s, e, _ in exp:
        prints.setdefault(s, o.pack(*o.sketch(pa.array([s])))[0])
    assert {r["fingerprint"] for r in got} == set(prints.values())
    assert prints[""] == prints["  \n\t "] == ""


def test_fingerprint_likeness_is_near_jaccard():
    from raretide.llm import op1_fingerprints as o
    r, errors = random.Random(3), []
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        for n in (1, 3, 30, 400):
            base = [f"w{r.random()}" for _ in range(n + 4)]
            cut = round(len(base) * share)
            other = base[:cut] + [f"v{r.random()}" for _ in range(len(base) - cut)]
            sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (base, other)]
            true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            a, b = (o.sketch(pa.array([" ".join(w)])) for w in (base, other))
            errors.append(abs(o.likeness(*a, *b)[0] - true))
    assert max(errors) < 0.25 and np.mean(errors) < 0.06


def test_densification_is_the_same_by_either_way(monkeypatch):
    from raretide.llm import op1_fingerprints as o
    r = np.random.default_rng(1)
    cells = np.where(r.random((6, o.BINS)) < np.array([[0.0], [0.002], [0.01], [0.1], [0.5], [1.0]]), r.integers(0, 1 << 50, (6, o.BINS), dtype=np.uint64), o._NONE)
    cells[1, 3] = 5
    got = o._densify(cells)
    order, _ = o._orders()
    for d, row in enumerate(cells):
        filled = row != o._NONE
        for b in range(o.BINS):
            exp = row[b] if filled[b] or not filled.any() else row[next(c for c in order[b] if filled[c])]
            assert got[d, b] == exp


def test_fingerprints_of_nothing(spark, none):
    from raretide.llm import op1_fingerprints as o
    assert o.edited_fingerprints(none).count() == 0
    assert o.fingerprint(none).count() == 0
    one = docs_frame(spark, [(1, "a b c d e f", "en", "a")])
    r, = o.edited_fingerprints(one).collect()
    assert r["near_next"] == 1.0  # it is its own next
    assert o.fingerprint(one).first()["fingerprint"] == r["fingerprint"]


# ---------------------------------------------------------------- 2 toxicity

def _toxic_tables(spark, n=400):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = prose(i, r.randint(5, 120))
        if toxic:
            text += " " + r.choice(["grobian", "Gr0bian!", "gr\u043ebian", "flegelhaft", "flegelei"]) + " " + prose(i + 1, 3)
        elif i % 50 == 1:
            text += " grobian museum"
        rows.append((i, text, "en", "a"))
        labels.append((i, 1, int(toxic)))
    return docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_folds_and_excepts(spark, odd, none):
    from raretide.llm import op2_toxicity as o
    docs, labels = _toxic_tables(spark)
    model = o.learn(o.sample(docs, labels))
    assert any(" grobian " == t or t.startswith(" grob") for t, _ in model["terms"])
    assert any("museum" in p for p in model["exceptions"])
    got = {r["doc_id"]: r["score"] for r in o.score(docs, model, ["doc_id"]).collect()}
    truth = {i: i % 4 == 0 for i in range(400)}
    assert np.mean([(got[i] >= 0.5) == t for i, t in truth.items()]) > 0.98
    rows = o.score(odd, model, ["doc_id", "text"]).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] < 0.5 for r in rows if not (r["text"] or "").strip())
    assert o.score(none, model, ["doc_id"]).count() == 0
    empty = o.learn(o.sample(none, labels))
    assert {r["score"] for r in o.score(odd, empty, ["doc_id"]).collect()} == {0.0}


def test_folding():
    from raretide.llm import op2_toxicity as o
    assert o.folded("L0ser, \uff33TUPID $cum a@b 9$") == o.folded("loser stupid scum aab")
    assert o.folded("l\u043es\u0435r") == o.folded("LOSER") and o.folded(None) == o.folded(" .. ") == " "
    found = o.hits(o.folded("a bad badly b4d"), ((" bad ", 2.0), (" bad", 1.0)))
    assert found == {2: 2.0, 6: 1.0, 12: 2.0}


def test_without_a_telling_term_nothing_is_toxic(spark):
    """Labels that no word explains: the lowest score for all."""
    from raretide.llm import op2_toxicity as o
    docs = docs_frame(spark, [(i, "all the same words here", "en", "a") for i in range(60)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    got = o.score(docs, o.learn(o.sample(docs, labels)), ["doc_id"]).collect()
    assert {r["score"] for r in got} == {0.0}


# ---------------------------------------------------------------- 3 decontamination

def _op3_brute(docs, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a:a + k])].add(i)
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in windows:
                    hit.update(range(a, a + k))
                    found |= windows[tuple(w[a:a + k])]
        out.append((i is None, i or 0, len(w), len(hit), tuple(sorted(map(str, found)))))
    return sorted(out)


@pytest.mark.parametrize("block", [400_000, 20])
def test_decontamination_equals_brute_force(spark, odd, none, monkeypatch, block):
    from raretide.llm import op3_decontamination as o
    monkeypatch.setattr(o, "BLOCK", block)
    passage = prose(77, 30)
    items = [(1, passage), (2, passage[40:] + " end"), (3, "Two words"), (4, None), (5, ""), (6, "one"), (7, "zz " * 12), (8, prose(78, 7)), (9, "größer NIÑO")]
    extra = [(20, f"x {passage} y", "en", "a"), (21, passage.upper().replace(" ", "--"), "en", "a"), (22, "zz " * 30, "en", "a"), (23, prose(1, 5) + " " + prose(78, 7), "en", "b"), (24, passage[:50], "en", "b")]
    docs = odd.unionByName(docs_frame(spark, extra)).unionByName(docs_frame(spark, extra[:1]))
    bench = spark.createDataFrame([(i, t, "w", 3) for i, t in items], "item_id long, text string, words string, length int")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"], tuple(sorted(map(str, r["items"])))) for r in o.judge(docs, bench).collect())
    assert got == _op3_brute(rows, items)
    kept = o.clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(g[3] == 0 for g in got)
    assert o.judge(none, bench).count() == 0 and o.clean(none, bench).count() == 0
    assert {r["n_hit"] for r in o.judge(odd, bench.limit(0)).collect()} == {0}


# ---------------------------------------------------------------- 4 URL rules

def test_urls_are_parsed_and_ruled(spark):
    from raretide.llm import op4_url_rules as o
    urls = ["http://A.Example.com/en/x?y#z", "https://www.example.com/en/", "http://example.com", "http://com/", "x://de.net/fr/1", "http://net/frx", None, "", "no-scheme/en/",
            "http://ex.net?u=/es/", "http://ex.net#/es/", "ftp://h/p?q://z/es/", "://net/es/", "http://notexample.com/en/", "http://example.com/EN/", "http://É.net/es/a"]

    def brute(u):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
            host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
        fits = [(v, h + p) for v, h, p in o.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        v, name = max(fits, key=lambda f: len(f[1]), default=(None, None))
        return host, path, name, v

    pages = spark.createDataFrame([(k, u, "h", "x") for k, u in enumerate(urls)] + [(0, urls[0], "h", "x"), (None, None, None, None)], "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = o.judge(pages, labels).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        host, path, name, verdict = brute(urls[r["page_id"]] if r["page_id"] is not None else None)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, name, verdict or "allow"), urls[r["page_id"]]
    assert o.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_equal_counting(spark):
    from raretide.llm import op4_url_rules as o
    r = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        spam, shop = r.random() < 0.4, r.random() < 0.5
        rows.append((i, f"http://{'spam' if spam else 'site'}.example.org/{'buy' if shop else 'read'}/{i}{'.html' if r.random() < 0.3 else ''}"))
        bad = spam and shop and r.random() < 0.95
        labels.append((i, 0 if bad else 1, 0))
    pages, lab = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    host, path = o.host_path(F.col("url"))
    mined = o.mine(pages.select("*", host.alias("host"), path.alias("path")), lab)
    baskets = [(frozenset(o.tokens(u.split("/")[2], "/" + u.split("/", 3)[3], u)), labels[i][1] == 0) for i, u in rows]
    tokens = sorted(set().union(*(b for b, _ in baskets)))
    good = {}
    for k in (1, 2, 3):
        for c in itertools.combinations(tokens, k):
            hit = [bad for b, bad in baskets if b >= set(c)]
            if sum(hit) >= max(o.MIN_PAGES, o.MIN_SUPPORT * len(baskets)) and hit and sum(hit) / len(hit) >= o.MIN_CONFIDENCE and sum(hit):
                if not any(set(g) < set(c) for g in good):
                    good[c] = sum(hit) / len(hit)
    assert {tuple(sorted(rule)): round(conf, 9) for rule, conf in mined if len(rule) <= 3} == {k: round(v, 9) for k, v in good.items()}
    got = {r["page_id"]: r["mined"] for r in o.judge(pages, lab).collect()}
    rules = [set(rule) for rule, _ in mined]
    assert got == {i: "block" if any(rule <= b for rule in rules) else "allow" for i, (b, _) in enumerate(baskets)}


@pytest.mark.parametrize("most", [4, 0])
def test_no_rule_is_cut_off(spark, monkeypatch, most):
    """Many redundant rules of confidence 1 leave the less confident ones in place, sent or joined."""
    from raretide.llm import op4_url_rules as o
    monkeypatch.setattr(o, "MAX_RULES", most)
    urls = [("http://bad.org/telling/a/b/c/d", 0)] * 6 + [("http://odd.org/x", 0)] * 4 + [("http://odd.org/x", 1)] * 3 + [("http://fine.org/a/b/c/d", 1)] * 8
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(urls)], "doc_id long, quality int, toxic int")
    host, path = o.host_path(F.col("url"))
    assert {r for r, _ in o.mine(pages.select("*", host.alias("host"), path.alias("path")), labels)} == {("host1:bad",), ("path:telling",), ("host1:odd",), ("path:x",)}
    got = {r["page_id"]: r["mined"] for r in o.judge(pages, labels).collect()}
    assert got == {i: "allow" if "fine" in u else "block" for i, (u, _) in enumerate(urls)}


def test_long_urls_and_lone_pages(spark):
    """URLs of 200 path words, in several copies, end in seconds and one page alone makes no rule."""
    import time

    from raretide.llm import op4_url_rules as o
    long = "http://long.org/" + "/".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(200))
    urls = [(long, 0)] * 4 + [("http://lone.org/only", 0)] + [(f"http://fine.org/p{i}", 1) for i in range(60)] + [("file:///en/x", 1), (None, 0)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in enumerate(urls)], "doc_id long, quality int, toxic int")
    began = time.time()
    got = {r["page_id"]: r["mined"] for r in o.judge(pages, labels).collect()}
    assert time.time() - began < 60
    assert got == {i: "block" if u == long else "allow" for i, (u, _) in enumerate(urls)}


# ---------------------------------------------------------------- 5 mixing

def _fill(sizes, weights, share=1.5, most=2.0):
    """Clamp and reshare until none is above its cap."""
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        weight = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / weight > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return {s: most * sizes[s] if s in capped else left * weights[s] / weight for s in sizes}
        capped |= set(over)


@pytest.mark.parametrize("digits", [1, 3])
def test_mixing_fills_and_samples(spark, odd, none, monkeypatch, digits):
    from raretide.llm import op5_mixing as o
    monkeypatch.setattr(o, "BUCKET_DIGITS", digits)
    r = random.Random(4)
    rows = [(i, prose(i, r.randint(1, 60)), "en", r.choice(["a", "a", "a", "a", "B", "é", "zz", None])) for i in range(400)]
    docs = docs_frame(spark, rows)
    got = o.mix(docs, o.cycle_weight()).collect()
    size = collections.Counter()
    for i, t, _, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    target = _fill(size, {s: [3, 1, 2][k % 3] for k, s in enumerate(order)})
    taken, largest = collections.Counter(), collections.Counter()
    for row in got:
        s = row["source"]
        assert row["source_size"] == size[s] and row["target"] == pytest.approx(target[s])
        assert row["taken"] in (0, row["size"], 2 * row["size"])
        taken[s] += row["taken"]
        largest[s] = max(largest[s], row["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in size)
    again = {r["doc_id"]: r["taken"] for r in o.mix(docs, o.cycle_weight()).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    full = collections.Counter(r["doc_id"] for r in o.repeat(docs, o.cycle_weight()).collect())
    assert all(full.get(r["doc_id"], 0) == r["repeats"] for r in got)
    rows = o.mix(odd, o.cycle_weight()).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if not r["size"])
    out = o.repeat(odd, o.cycle_weight())
    assert out.columns == odd.columns and out.count() == sum(r["repeats"] for r in rows)
    assert o.mix(none, o.cycle_weight()).count() == 0 and o.repeat(none, o.cycle_weight()).count() == 0


# ---------------------------------------------------------------- 6 and 7 tokens

SPECIAL = ["a  b", "<|endoftext|> x</s> <s>", " lead", "trail ", "x\n b", "\n\nfoo\n\nbar", "it's, he'd.ok 3.14, a", "é\u3000 b", "foo.\nBar baz.\n", "\x1c x", "a\u2003 b", "\u2581x \u2581", "\n\n\n.",
           "a,\nb", ",", ".\n", "1.5.\n\n\n2", "\t\t x\r\n y", "x" * 300 + " " + "é" * 100, "   ", "a\xa0 b", "I'll 've's 'S", "x.\n\n", "\n\n", "\n\nx,"]


def test_token_counts_equal_the_library(spark, odd, none):
    import sentencepiece
    from raretide.llm import op6_token_counts as o
    sp = sentencepiece.SentencePieceProcessor(model_file=o.vocabulary_path())
    docs = odd.unionByName(docs_frame(spark, [(100 + i, t, "en", "a") for i, t in enumerate(SPECIAL)]))
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    key = lambda i, *x: (i is None, i or 0, *x)
    for top in (10, 200_000):
        got = sorted(key(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in o.count_tokens(docs, o.vocabulary_path(), top=top).collect())
        exp = sorted(key(i, len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in rows)
        assert got == exp
    assert o.count_tokens(none, o.vocabulary_path()).count() == 0


def test_token_files_round_trip(spark, odd, none, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    from raretide.llm import op7_token_files as o
    library = Tokenizer.from_file(o.vocabulary_path())
    docs = odd.where("doc_id IS NOT NULL").unionByName(docs_frame(spark, [(100 + i, t, "en", "a") for i, t in enumerate(SPECIAL)]))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: r[0])
    o.write_tokens(docs, str(tmp_path / "t"), o.vocabulary_path())
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in o.read_tokens(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    ids = {t: library.encode(t, add_special_tokens=False).ids + [0] for _, t in rows}
    assert [g[0] for g in got] == [r[0] for r in rows]
    at = 0
    for i, start, n, crc in got:
        assert start == at
        assert any(len(ids[t]) == n and zlib.crc32(np.array(ids[t], dtype="<u4").tobytes()) == crc for j, t in rows if j == i)
        at += n
    hash_, raw = spark.read.parquet(str(tmp_path / "t" / "dictionary")).first()
    assert hashlib.sha256(bytes(raw)).hexdigest() == hash_
    with_null = o.read_tokens(spark, _written(o, odd, tmp_path / "u")).collect()
    assert len(with_null) == odd.count()
    assert o.read_tokens(spark, _written(o, none, tmp_path / "v")).count() == 0


def test_one_document_is_read_by_the_index(spark, odd, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    from raretide.llm import op7_token_files as o
    monkeypatch.setattr(o, "BLOCK", 2000)  # many blocks
    library = Tokenizer.from_file(o.vocabulary_path())
    folder = _written(o, odd, tmp_path / "t")
    for i, t in {r["doc_id"]: r["text"] for r in odd.where("doc_id IN (0, 3, 5, 9)").collect()}.items():
        (ids,) = o.read_document(spark, folder, i)
        assert ids.tolist() == library.encode(t or "", add_special_tokens=False).ids + [o.END]
    assert len(o.read_document(spark, folder, 6)) == 2 and o.read_document(spark, folder, 12345) == []


def _written(o, docs, path):
    o.write_tokens(docs, str(path), o.vocabulary_path())
    return str(path)


# ---------------------------------------------------------------- 8 near duplicates

def _op8_brute(rows, width, threshold=80):
    """Component id of each row by comparing all pairs."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    sets = [frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset() for w in words]
    label = list(range(len(rows)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            label[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for a in range(len(rows)):
        groups[find(a)].append(rows[a][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(rows[a][0], len(sets[a]), least[find(a)]) for a in range(len(rows))], len(groups)


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, odd, width):
    from raretide.llm import op8_near_duplicates as o
    r = random.Random(9)
    rows = []
    for g in range(6):  # chains: each copy edits the one before, so ends are far apart
        text = prose(100 + g, 120, [f"{w}{x}" for w in WORDS for x in range(9)]).split()
        for k in range(14):
            rows.append((1000 + 20 * g + k, " ".join(text), "en", "a"))
            for _ in range(r.choice([0, 1, 2, 4])):
                text[r.randrange(len(text))] = f"new{r.random()}"
    rows += [(2000 + i, prose(500 + i, r.randint(1, 60)), "en", "a") for i in range(40)]
    docs = odd.unionByName(docs_frame(spark, rows))
    plain = [(x["doc_id"], x["text"]) for x in docs.collect()]
    exp, groups = _op8_brute(plain, width)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] is None, x[2] or 0)
    got = [(x["doc_id"], x["n"], x["component_id"]) for x in o.near_duplicates(docs, width).collect()]
    assert sorted(got, key=key) == sorted(exp, key=key)
    kept = o.keep_one(docs, width)
    assert kept.columns == docs.columns and kept.count() == groups


def test_near_duplicates_behind_unlike_pivots(spark):
    """One sentence pool: every table's pivot is unlike most of its classes, near copies are still found."""
    from raretide.llm import op8_near_duplicates as o
    pool, n, pairs, size, edits = 500, 1600, 750, 305, 33
    rng = np.random.default_rng(11)
    sets = np.zeros((n, pool), dtype=bool)
    for i in range(n):
        sets[i, rng.permutation(pool)[:size]] = True
    for i in range(pairs):  # the last ones, so that tables have smaller classes
        twin, own = sets[n - 2 * i - 1], sets[n - 2 * i - 2]
        swap = rng.permutation(np.flatnonzero(own))[:edits], rng.permutation(np.flatnonzero(~own))[:edits]
        twin[:] = own
        twin[swap[0]], twin[swap[1]] = False, True
    words = np.array([f"w{i}" for i in range(pool)])
    docs = spark.createDataFrame([(i, " ".join(words[s])) for i, s in enumerate(sets)], "doc_id long, text string")
    m = sets.astype(np.float32)
    both = m @ m.T
    either = 2 * size - both
    near = both * 100 >= either * 80
    assert near.sum() == n + 2 * pairs and 0.42 < np.median(both / either) < 0.45
    got = {r["doc_id"]: r["component_id"] for r in o.near_duplicates(docs, 1).collect()}
    assert [got[i] for i in range(n)] == near.argmax(axis=1).tolist()


def test_near_duplicates_block_compare(monkeypatch):
    """Members that no pivot reaches are found by the blocks."""
    from raretide.llm import op8_near_duplicates as o
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 5, 40, 45)]
    side = lambda rows: pa.table({"cid": [k for k in rows], "comp": [k for k in rows], "s": [sets[k].tobytes() for k in rows]})
    got = o._block_links(80)(side([1, 2]), side([0, 1, 2, 3])).to_pylist()
    assert sorted((g["a"], g["b"]) for g in got) == [(0, 1), (2, 3)]


def test_near_duplicates_of_nothing(none):
    from raretide.llm import op8_near_duplicates as o
    assert o.near_duplicates(none).count() == 0 and o.keep_one(none).count() == 0


def test_components_end_with_the_round_that_makes_stars(spark, monkeypatch):
    """No round over stars, and none that only finds that nothing changes: each is some ten stages that the driver keeps track of."""
    from raretide.llm import op8_near_duplicates as o
    tables, kept = [], o.written
    monkeypatch.setattr(o, "written", lambda df, name: tables.append(name) or kept(df, name))

    def found(edges):
        tables.clear()
        got = {x["node"]: x["label"] for x in o.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
        return got, len(tables)

    assert found([(5, 1), (1, 4), (4, 1), (9, 8), (3, 3)]) == ({5: 1, 4: 1, 1: 1, 9: 8, 8: 8}, 1)
    assert found([]) == ({}, 1)
    assert found([(3, 1), (3, 2)]) == ({1: 1, 2: 1, 3: 1}, 2)  # two smaller neighbours
    assert found([(2, 1), (3, 2)]) == ({1: 1, 2: 1, 3: 1}, 2)  # a chain


def test_components_of_chains_and_stars(spark):
    from raretide.llm import op8_near_duplicates as o
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    label = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {x["node"]: x["label"] for x in o.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(got.get(n, n) == m for n, m in label.items())


# ---------------------------------------------------------------- 9 quality

def test_quality_prefers_and_thresholds(spark, odd, none):
    from raretide.llm import op9_quality as o
    rows, labels = [], []
    for i in range(500):
        bad = i % 6 == 0
        text = prose(i, 80)
        rows.append((i, text.upper().replace(" ", "!! ") if bad and i % 12 else " | ".join(text.split()) if bad else text, "en", "a"))
        labels.append((i, 0 if bad else 1, 0))
    docs, lab = docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = o.learn(o.sample(docs, lab))
    got = {r["doc_id"]: r["score"] for r in o.score(docs, model, ["doc_id"]).collect()}
    assert np.mean([(got[i] >= 0.3) == (i % 6 != 0) for i in range(500)]) > 0.99
    rows = o.score(odd, model, odd.columns, out="quality")
    assert rows.columns == [*odd.columns, "quality"] and rows.count() == odd.count()
    assert o.score(none, model, ["doc_id"]).count() == 0
    flat = o.learn(o.sample(none, lab))
    assert all(r["score"] == pytest.approx(1.0) for r in o.score(odd, flat, ["doc_id"]).collect())


def test_quality_learns_from_all_labelled_rows(spark):
    from raretide.llm import op9_quality as o
    docs = spark.range(26_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("BUY NOW!! "), "id")).otherwise(
        F.concat(F.lit("a quiet line of words "), "id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    train = o.training(docs, labels)
    known = [i for i in range(26_000) if zlib.crc32(str(i).encode()) % 5]
    assert len(known) > 20_000 and train.count() == len(known)
    model = o.learn(train)
    # threshold and slope are the quantile and the median distance of all margins
    x = np.array([r["x"] for r in train.select("x").collect()])
    m, n0 = np.sort(x @ np.array(model["weights"])), sum(i % 3 == 0 for i in known)
    assert model["threshold"] == pytest.approx((m[n0 - 1] + m[n0]) / 2, abs=1e-8)
    assert model["slope"] == pytest.approx(4 / np.median(np.abs(m - model["threshold"])), rel=1e-6)
    assert o.learn(train.where("quality = 1"))["level"] == 1.0


# ---------------------------------------------------------------- 10 language

def test_suffix_automaton_parses_like_brute_force():
    from raretide.llm import op10_language as o
    r = random.Random(1)
    for _ in range(40):
        train = "".join(r.choice("abc") for _ in range(r.randint(1, 60)))
        text = "".join(r.choice("abcd") for _ in range(r.randint(1, 80)))
        n, at = 0, 0
        while at < len(text):
            k = 0
            while at + k < len(text) and text[at:at + k + 1] in train:
                k += 1
            at += max(k, 1)
            n += 1
        sym = {c: i + 1 for i, c in enumerate(sorted(set(train)))}
        steps = o.suffix_automaton(np.array([sym[c] for c in train], dtype=np.uint16), len(sym) + 1)
        lane = np.array([[sym.get(c, 0) for c in text]], dtype=np.uint16)
        assert o.phrases(lane, np.array([len(text)]), steps, 0)[0] == n


def test_marks_alone_are_no_letters(spark):
    from raretide.llm import op10_language as o
    training = (("aa", "some training text"), ("bb", "andere woerter"))
    lang, score = o.identify(["\u0301\u0308", "e\u0301", "\u0301 x", None, "12"], training)
    assert lang[0] == lang[3] == lang[4] == o.UNKNOWN and lang[1] != o.UNKNOWN and lang[2] != o.UNKNOWN


def test_language_is_told(spark, odd, none):
    from raretide.llm import op10_language as o
    r = random.Random(1)
    parts = {"aa": ["lo", "mi", "ra", "te"], "bb": ["krz", "sch", "ung", "pf"], "cc": ["é", "ño", "ción", "la"]}
    rows = [(i, " ".join("".join(r.choice(parts[lang]) for _ in range(3)) for _ in range(r.randint(3, 900))), lang, "a")
            for i, lang in enumerate(random.Random(2).choices(list(parts), k=240))]
    docs = docs_frame(spark, rows)
    training = o.learn(docs)
    assert [t[0] for t in training] == ["aa", "bb", "cc"]
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in o.predict(docs, training, ["doc_id"]).collect()}
    assert np.mean([got[i][0] == lang for i, _, lang, _ in rows]) > 0.97
    rows = o.predict(odd, training, ["doc_id", "text"]).collect()
    assert len(rows) == odd.count()
    for x in rows:
        letters = any(c.isalpha() for c in x["text"] or "")
        assert (x["lang_pred"] == "und") != letters and 0 <= x["score"] <= 1
    assert o.predict(none, training, ["doc_id"]).count() == 0
    assert {x["lang_pred"] for x in o.predict(odd, o.learn(none), ["doc_id"]).collect()} == {"und"}


def test_blocks_only_cut_phrases():
    from raretide.llm import op10_language as o
    training = (("aa", "lora mite lomi"), ("bb", "schung pfkrz"))
    long = "lomi rate " * 4000
    lang, score = o.identify([long, long[:40], None, "12"], training)
    assert lang == ["aa", "aa", "und", "und"] and score[2:] == [0.0, 0.0] and score[0] > 0.3
    assert math.isclose(o.identify(["lomi"], training[:1])[1][0], 1.0)


def test_block_parse_is_whole_text_parse(monkeypatch):
    from raretide.llm import op10_language as o
    r = random.Random(5)
    training = (("aa", "".join(r.choice("ab ") for _ in range(70))), ("bb", "".join(r.choice("abc") for _ in range(60))), ("cc", "a" * 30))

    def brute(text, train):
        n, at = 0, 0
        while at < len(text):
            k = 0
            while at + k < len(text) and text[at:at + k + 1] in train:
                k += 1
            at += max(k, 1)
            n += 1
        return n

    def plain(text):
        return "".join(map(chr, o.letters(text)))

    texts = ["".join(r.choice("abcd ") for _ in range(r.randint(1, 300))) + "a" for _ in range(60)] + ["a" * 500, "ab" * 200, None, "..", "a"]
    whole = {}
    for block, few in itertools.product((1, 2, 7, 64, 10_000), (0, 3, 1000)):
        monkeypatch.setattr(o, "BLOCK", block)
        monkeypatch.setattr(o, "FEW", few)
        langs, scores = o.identify(texts, training)
        for t, lang, score in zip(texts, langs, scores):
            if not t or t == "..":
                assert (lang, score) == (o.UNKNOWN, 0.0)
                continue
            counts = whole.setdefault(t, [brute(plain(t), plain(x)) for _, x in training])
            low, second = sorted(counts)[:2]
            assert lang == training[counts.index(low)][0] and math.isclose(score, 1 - low / max(second, 1))


def test_training_texts_are_whole_and_bounded(spark):
    from raretide.llm import op10_language as o
    rows = [(i, chr(97 + i % 7) * (i % 40 + 1), "aa" if i % 3 else "bb", "s") for i in range(300)]
    rows += [(1000, "x" * 900, "cc", "s"), (1002, "y" * 700, "cc", "s"), (1003, "y" * 700, "cc", "s"), (1004, "", "dd", "s"), (1005, None, "dd", "s")]
    docs = docs_frame(spark, rows)
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    got = dict(o.learn(docs, rows=12, chars=200, longest=30))
    for lang, text in got.items():
        parts = text.split("\n")
        allowed = [t for i, t, known, _ in rows if known == lang and t and i not in held]
        assert parts and all(p in allowed for p in parts)
        if lang != "cc":
            assert len(parts) <= 12 and sum(map(len, parts)) <= 200 and max(map(len, parts)) <= 30
        else:  # no text is short enough: a shortest one, whole
            assert len(parts) == 1 and len(parts[0]) == min(map(len, allowed))
    assert "dd" not in got and o.learn(docs, rows=12, chars=200, longest=30) == o.learn(docs.repartition(5), rows=12, chars=200, longest=30)
