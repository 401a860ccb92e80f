"""The operators against brute force on small fixtures with nulls, empty texts, ties and repeated rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlens.llm.decontaminate import decontaminate
from assetlens.llm.embeddings import embedding_dedup
from assetlens.llm.maxent import maxent_score
from assetlens.llm.mixing import mix_to_targets
from assetlens.llm.ngram_join import ngram_jaccard_join
from assetlens.llm.quality import quality
from assetlens.llm.rlz_dedup import rlz_dedup
from assetlens.llm.suffix_dedup import common_prefixes, suffix_array, suffix_array_dedup
from assetlens.llm.toxicity import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    rng = random.Random(3)
    some = lambda n: " ".join(rng.choice("ab cé ünd the of Tion x y z er st lo".split(" ")) for _ in range(n))
    shared = some(80)
    base = some(60)
    rows = [None, "", "   ", "one", "one", shared, some(40) + shared + some(20), some(10) + "\n" + shared[:400], "la " * 300,
            base, base, base + " end", base.replace("the", "The"), some(1500)]
    for i in range(12):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append(" ".join(w))
    return [(i, t, i) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns bear names of results
    return spark.createDataFrame(texts(), "doc_id long, text string, n_removed long")


@pytest.mark.parametrize("hot", [3, 20_000])
def test_suffix_array_dedup(docs, hot):
    got = {r.doc_id: r for r in suffix_array_dedup(docs, size=60, hot=hot).collect()}
    raw = {i: (t or "").encode() for i, t, _ in texts()}
    seen = Counter(b[i : i + 60] for b in raw.values() for i in range(len(b) - 59))
    for k, b in raw.items():
        cover = np.zeros(len(b), bool)
        for i in range(len(b) - 59):
            if seen[b[i : i + 60]] > 1:
                cover[i : i + 60] = True
        assert (got[k].n_bytes, got[k].n_removed) == (len(b), int(cover.sum()))
        assert bytes(got[k].kept) == bytes(np.frombuffer(b, np.uint8)[~cover])
        assert len(got[k].spans) == int((cover & ~np.r_[False, cover[:-1]]).sum() if len(b) else 0)


@pytest.mark.parametrize("hot", [3, 20_000])
def test_rlz_dedup(docs, hot):
    got = {r.doc_id: r for r in rlz_dedup(docs, window=12, hot=hot).collect()}
    raw = {i: WORD.findall(t or "") for i, t, _ in texts()}
    seen = Counter(tuple(w[i : i + 12]) for w in raw.values() for i in range(len(w) - 11))
    for k, w in raw.items():
        cover = [False] * len(w)
        for i in range(len(w) - 11):
            if seen[tuple(w[i : i + 12])] > 1:
                cover[i : i + 12] = [True] * 12
        assert (got[k].n_words, got[k].n_removed) == (len(w), sum(cover))
        assert got[k].kept == " ".join(x for x, c in zip(w, cover) if not c)


def test_suffix_array_and_prefixes():
    text = np.frombuffer(b"mississippi banana mississippi" * 3, np.uint8)
    sa, _ = suffix_array(text, len(text))
    raw = bytes(text)
    assert [raw[i:] for i in sa] == sorted(raw[i:] for i in range(len(raw)))
    lcp = common_prefixes(text, sa, suffix_array(text, len(text))[1], len(text))
    for a, b in zip(sa, sa[1:]):
        x, y = raw[a:], raw[b:]
        assert lcp[b] == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def linked(rows):
    """(set size, smallest doc_id that links reach) of each document, over all pairs."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            i = len(sets[a] & sets[b])
            if a < b and i and 100 * i >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_ngram_join(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(docs).collect()}
    assert got == linked([(i, t) for i, t, _ in texts()])


def test_ngram_join_drifting_copies(spark):
    """A crowd of copies, chains that drift away from it, and others that share only a part of it."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(60)]
    rows = []

    def edited(w, n):
        w = list(w)
        for k in rng.sample(range(len(w)), n):
            w[k] = f"e{rng.randrange(50)}"
        return w

    for _ in range(40):
        rows.append(edited(base, rng.choice([0, 1, 1, 2])))
    for _ in range(8):
        w = base
        for _ in range(6):
            w = edited(w, 1)
            rows.append(w)
    for _ in range(12):
        k = rng.randrange(20, 55)
        rows.append(base[:k] + [f"o{rng.randrange(9999)}" for _ in range(60 - k)])
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows)
    assert 1 < len({c for _, c in got.values()}) < len(rows)


def test_decontaminate(spark, docs):
    t = [x or "" for _, x, _ in texts()]
    items = [(1, " ".join(t[5].split()[:14])), (2, "edit3"), (3, None), (4, ""), (5, "one"), (5, "one"), (10, t[9].upper())]
    got = {r.doc_id: r for r in decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=64).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = lambda x: word.findall((x or "").translate(LOWER))
    windows = {(tuple(w[i : i + 10]), str(k)) for k, x in items if (w := own(x)) for i in range(max(1, len(w) - 9))}
    for i, x, _ in texts():
        w, hit, names = own(x), set(), set()
        for win, k in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    names.add(k)
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(w), len(hit), sorted(names))


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    x = np.r_[base, base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:5]].astype(np.float32)
    rows = [(i, [float(v) for v in r], i % 2 if i < 40 else (i - 40) % 20 % 2) for i, r in enumerate(x)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [float("nan")] * 16, 1), (104, rows[0][1], None),
             (105, [None, 1.0], 0), (106, rows[0][1][:7], 0)]
    got = {r.vec_id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    fine = [r for r in rows if r[0] < 100]
    root, links = {r[0]: r[0] for r in rows}, Counter()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in fine}
    pairs = [(a[0], b[0]) for a in fine for b in fine if a[0] < b[0] and a[2] == b[2] and unit[a[0]] @ unit[b[0]] >= 0.93]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in rows:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    found = sum(r.n_links for r in got.values())
    assert found >= 0.9 * 2 * len(pairs) and all(got[i].n_links <= links[i] for i in got)
    assert set(got) == {r[0] for r in rows}
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(100, 107))
    assert found < 2 * len(pairs) or all(got[i].component_id == root[i] for i in got)


def test_maxent(docs):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    got = {r.doc_id: r for r in maxent_score(docs, held).collect()}
    own = {i: WORD.findall((t or "").translate(LOWER)) + ["\n"] for i, t, _ in texts()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in own}
    count = Counter(w for i, x in own.items() if not out[i] for w in x)
    n, v = sum(count.values()), len(count)
    for i, x in own.items():
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (
            out[i], len(x), sum(count[w] > 0 for w in x), n)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and math.isfinite(got[i].score)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_classifiers_and_mixing(spark):
    rng = random.Random(1)
    clean = lambda: " ".join(rng.choice("ala bel cor dun eli fon".split()) + rng.choice("ta ri no".split()) for _ in range(30))
    rows = [(i, clean() + (" moron scum" if i % 4 == 0 else "") if i % 5 else ("spam " * 40 + ("moron scum" if i % 4 == 0 else "")))
            for i in range(200)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(bool(i % 5)), int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    train = F.col("doc_id") % 3 != 1
    for op, column, want in ((toxicity, "toxic", lambda i: i % 4 == 0), (quality, "quality", lambda i: bool(i % 5))):
        got = {r.doc_id: r for r in op(docs, labels.select("doc_id", column), train).collect()}
        assert sum(got[i].predicted == want(i) for i in range(1, 200, 3)) >= 64
        assert len(got) == 202 and 0 <= got[900].score == got[901].score <= 1
    none = labels.where("doc_id < 0")
    assert {r.score for r in toxicity(docs, none).collect()} == {0.0}
    mixed = mix_to_targets(docs, labels, {0: 0.25, 1: 0.05, 2: 0.5, 3: 0.2}).collect()
    total = sum(r.n_tokens for r in mixed)
    got = np.array([np.array(r.posterior) * r.rate * r.n_tokens for r in mixed]).sum(0) / total
    assert np.abs(got - [0.25, 0.05, 0.5, 0.2]).max() < 0.02 and min(r.rate for r in mixed) >= 0
    assert {r.rate for r in mix_to_targets(docs, none).collect()} == {1.0}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not suffix_array_dedup(docs).collect() and not rlz_dedup(docs).collect() and not ngram_jaccard_join(docs).collect()
    assert not toxicity(docs, labels).collect() and not quality(docs, labels).collect()
    assert not mix_to_targets(docs, labels).collect()
    assert not decontaminate(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert not maxent_score(docs, F.lit(False)).collect()
    assert not embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect()


def test_chat_sql(spark):
    import compare
    from assetlens.llm.queries import ORACLES, QUERIES
    name, sf = "op2_collapse_chats", "/root/testdata/sf0.001"
    assert compare.compare(spark, compare.duck(sf), sf, QUERIES[name], ORACLES[name])[0] == "ok"


