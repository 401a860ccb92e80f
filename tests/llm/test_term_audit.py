"""The audit against exact counting in Python; collisions of digests and tiles of sources change nothing."""

import random
import re
from collections import Counter, defaultdict

import pytest

from assetlens.llm.term_audit import term_audit

TERM = re.compile("[A-Za-z\u0080-\U0010ffff]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rng = random.Random(6)
    words = [a + b for a in ("ab", "Zé", "Xu", "über", "mid") for b in ("a", "b", "ÑA", "dd", "e")]
    out = [(rng.choice(["en", "fr"]), f"s{rng.randrange(6)}",
            " 1".join(rng.choice(words[: rng.randrange(1, 26)]) for _ in range(rng.randrange(30)))) for _ in range(160)]
    out += [("en", "hot", "ab1ab mid-mid " * 200)] * 60 + [("en", "none", None), ("en", None, "aba"), (None, "s1", "aba abb"), ("de", "x", ""),
                                                    ("de", "y", "12 34"), ("one", "only", "aba aba"), ("one", "only", "aba"), ("one", "only", "aba")]
    return out


def audit(data, top):
    docs = [((a or ""), (b or ""), Counter(t.translate(LOWER) for t in TERM.findall(c or ""))) for a, b, c in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t in df if df[t] >= 3)
        count, whole = defaultdict(Counter), Counter()
        for _, s, c in own:
            count[s].update({t: n for t, n in c.items() if df[t] >= 3})
            whole.update({t: n for t, n in c.items() if df[t] >= 3})
        for _, s, _ in own:
            count[s]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in count if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, i, v, r + 1) for r, (v, i) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("bits, tile, batch", [(64, 256, 1 << 20), (4, 256, 2000), (2, 2, 500)])
def test_against_counting(spark, bits, tile, batch):
    data = rows()
    df = spark.createDataFrame([(*r, 1) for r in data], "lang string, source string, text string, rank int").repartition(4)
    got = sorted(tuple(r) for r in term_audit(df, top=5, tile=tile, batch_bytes=batch, bits=bits).collect())
    assert got == audit(data, 5)


def test_empty(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    out = term_audit(none)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and not out.count()
