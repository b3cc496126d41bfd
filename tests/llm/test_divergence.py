"""Divergence of sources against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from footfall.llm import divergence
from footfall.llm.divergence import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs):
    """All result rows over (text, lang, source) rows."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = TERM.findall((text or "").translate(UPPER))
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        share = lambda c, total: 1 + 10**9 * (c + 5) // (total + 5 * len(kept))

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: share(count[t], total) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            apart = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", apart), ("term", own)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(found, 1) if part == "pair" or r <= 50]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefghijkl" for b in ("Xy", "é", "ß", "中", "Ö", "q")]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s0", "s1", "S1", "ñ", None])
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(60)))
        rows.append((text.replace(" ", rng.choice([" ", "\n", "_", "7", ",\x00"])), lang, source))
    rows += [(None, "en", "s0"), ("", "en", "only empty"), ("123 ...", "xx", "a"), ("once", "xx", "b"), (None, "yy", None)]
    rows += [("Éa É é EA ea", "en", "s1")] * 5 + [("aXy " * 5000, "en", "s0")]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("min_docs", [1, 5, 30])
def test_equals_brute_force(spark, monkeypatch, small, min_docs):
    if small:  # many slices and shards; the merging of partial counts has its own test
        monkeypatch.setattr(divergence, "SHARD_ROWS", 40)
    rows = corpus()
    got = source_divergence(table(spark, rows).repartition(4), min_docs)
    assert sorted(map(tuple, got.collect())) == brute(rows, min_docs)


def test_partial_counts_add_up_however_they_are_cut(monkeypatch):
    rows = corpus()
    batch = pa.RecordBatch.from_pylist([dict(zip(("text", "lang", "source"), r)) for r in rows])
    whole = {tuple(r.values())[:3]: (r["n"], r["docs"]) for r in divergence.term_counts(batch).to_pylist()}
    monkeypatch.setattr(divergence, "SLICE_BYTES", 100)
    monkeypatch.setattr(divergence, "PARTIAL_ROWS", 50)
    cut = Counter(), Counter()
    for part in divergence._partial_counts([batch.slice(i, 40) for i in range(0, batch.num_rows, 40)]):
        for r in part.to_pylist():
            for total, name in zip(cut, ("n", "docs")):
                total[r["lang"], r["source"], r["term"]] += r[name]
    assert whole == {k: (cut[0][k], cut[1][k]) for k in cut[0]}


def test_shares_are_exact():
    import numpy as np

    rng = random.Random(1)
    for total in [5, 6, 1_000_003, 10**12 + 7, 9 * 10**15]:
        n = [0, *[rng.randrange(max(1, total - 5)) for _ in range(50)]]
        got = divergence.shares(np.array(n, np.int64), np.int64(total))
        assert got.tolist() == [1 + 10**9 * (c + 5) // total for c in n]


def test_empty_and_clashing_columns(spark):
    assert source_divergence(table(spark, [])).collect() == []
    rows = corpus()[:40]
    extra = table(spark, rows).selectExpr("*", "1 AS term", "2 AS n", "3 AS shard", "text AS item")
    assert sorted(map(tuple, source_divergence(extra, 2).collect())) == brute(rows, 2)
