"""Quality rules as weak supervision.

Every rule votes good (+1), bad (-1) or abstains (0) on a document. Nobody tells how good a rule is:
expectation-maximisation over the vote patterns estimates how often each rule votes rightly on good
and on bad documents, and the share of good ones, taking votes as independent given the class. A document is kept if its posterior
probability of being good reaches ``keep_at``; no single rule can reject it by itself, as it could
where all rules must pass. Documents failing the base rules are always rejected.

EM needs the number of documents per vote pattern only, at most 3^rules rows, so one pass over the
corpus suffices and its result is tiny whatever the corpus.

Nulls and empty texts: no words, all statistics 0, ``base_failed``. Repeated rows are judged one by
one. Extra columns are ignored. An empty table gives no rows.
"""

import math
from dataclasses import dataclass

from pyspark.sql import functions as F

from footfall.llm.common import SPACES, stage

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` >= ``bad``, good where it is <= ``good``, else abstains."""

    name: str
    value: str
    good: float
    bad: float


#: Production rules, on ratios of the base statistics.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.02, 0.1),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", 0.05, 0.2),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.05, 0.3),
    Rule("shouting", "n_upper / greatest(word_chars, 1)", 0.15, 0.5),
    Rule("exclaims", "n_exclaims / greatest(n_words, 1)", 0.05, 0.3),
    Rule("punctuation", "1 - n_alnum / greatest(word_chars, 1)", 0.15, 0.25),
    Rule("long_words", "abs(word_chars / greatest(n_words, 1) - 6)", 3.0, 7.0),
)


def _without(col, chars):
    return F.translate(col, chars, "")


def base_statistics(docs, id_col="doc_id", text_col="text", carry=False):
    """One row per document with the base statistics and the counts the rules need.

    ``carry`` keeps the whole row in a struct ``row``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = _without(text, SPACES)
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(_without(line, SPACES)) > 0)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    first = docs.select(
        F.col(id_col).alias("doc_id"),
        *([F.struct(*docs.columns).alias("row")] if carry else []),
        F.length(plain).cast("long").alias("word_chars"),
        (F.length(plain) - F.length(_without(plain, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(plain) - F.length(_without(plain, "!"))).cast("long").alias("n_exclaims"),
        F.length(F.regexp_replace(plain, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", "")).cast("long").alias("n_alnum"),
        lines.alias("lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
    )
    # inline() keeps a computed array from being evaluated again inside the lambdas above it.
    hashed = first.select(
        *[c for c in first.columns if c not in ("lines", "words")],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.inline(F.array(F.struct(F.col("words").alias("words")))),
    )
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    windows = F.when(
        F.size("words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW))))
    ).otherwise(F.array().cast("array<bigint>"))
    windowed = hashed.select(
        *[c for c in hashed.columns if c != "words"],
        F.size("words").cast("long").alias("n_words"),
        F.inline(F.array(F.struct(windows.alias("windows")))),
    )
    # Only texts with a repeated window go through the sort that finds its places.
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = windowed.select(
        *[c for c in windowed.columns if c != "windows"],
        F.inline(F.array(F.struct(F.when(repeats, placed).alias("placed")))),
    )
    # In order of (hash, place) a window occurs twice if it equals the one before or after it.
    nothing = F.lit(None).cast("bigint")
    hashes = F.col("placed")["h"]
    before = F.concat(F.array(nothing), hashes)
    after = F.concat(F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0))), F.array(nothing))
    marked = found.select(
        *[c for c in found.columns if c != "placed"],
        F.inline(F.array(F.struct(F.when(F.col("placed").isNotNull(), F.arrays_zip(
            F.col("placed")["i"].alias("i"), hashes.alias("h"), before.alias("b"), after.alias("a")
        )).alias("z")))),
    )
    twice = F.filter("z", lambda x: F.coalesce(x["h"] == x["b"], F.lit(False)) | F.coalesce(x["h"] == x["a"], F.lit(False)))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n")),
    )["n"]
    return marked.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("z")


def votes(stats, rules=RULES):
    """``stats`` with a column ``vote_<rule>`` per rule."""
    out = stats
    for rule in rules:
        value = F.expr(rule.value)
        out = out.withColumn(
            f"vote_{rule.name}", F.when(value >= rule.bad, -1).when(value <= rule.good, 1).otherwise(0)
        )
    return out


#: What is believed of a rule before any count: shares of the votes (bad, abstain, good) on documents
#: that are good and on those that are bad. A bad document has one defect or two, not all of them.
ON_GOOD, ON_BAD = (0.01, 0.05, 0.94), (0.3, 0.05, 0.65)


def fit_rules(patterns, n_rules, prior=0.7, iterations=200, smoothing=2.0, least_gain=3.0):
    """EM for the vote shares of every rule: ``patterns`` is a list of (votes, count).

    Returns (share of good documents, [(shares on good, shares on bad)] per rule). Shares are
    smoothed towards ``ON_GOOD`` and ``ON_BAD``. A bad vote must stay ``least_gain`` times as frequent
    on bad documents as on good ones, and a good vote no less frequent on good ones: a rule is known
    to be better than chance, which also keeps the two classes from changing places.
    """
    shares = [(ON_GOOD, ON_BAD)] * n_rules
    total = sum(n for _, n in patterns)
    for _ in range(iterations):
        good_sum = smoothing * prior
        seen = [[[smoothing * x for x in ON_GOOD], [smoothing * x for x in ON_BAD]] for _ in range(n_rules)]
        for vote, n in patterns:
            p = posterior_of(vote, prior, shares)
            good_sum += n * p
            for j, v in enumerate(vote):
                seen[j][0][v + 1] += n * p
                seen[j][1][v + 1] += n * (1 - p)
        new_prior = min(max(good_sum / (total + smoothing), 0.01), 0.99)
        new = [_anchored(_normal(good), _normal(bad), least_gain) for good, bad in seen]
        moved = max([abs(new_prior - prior), *(abs(a - b) for x, y in zip(new, shares) for u, v in zip(x, y) for a, b in zip(u, v))])
        prior, shares = new_prior, new
        if moved < 1e-7:
            break
    return prior, shares


def _normal(counts):
    total = sum(counts)
    return tuple(max(x / total, 1e-6) for x in counts)


def _anchored(good, bad, least_gain):
    good = (min(good[0], bad[0] / least_gain), good[1], good[2])
    return good, (bad[0], bad[1], min(bad[2], good[2]))


def posterior_of(vote, prior, shares):
    odds = math.log(prior / (1 - prior)) + sum(_weight(v, *s) for v, s in zip(vote, shares))
    return 1 / (1 + math.exp(-max(min(odds, 700.0), -700.0)))


def _weight(vote, on_good, on_bad):
    """Log likelihood ratio of a vote."""
    return math.log(on_good[vote + 1] / on_bad[vote + 1])


def _judged(docs, rules, keep_at, id_col, text_col, carry):
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = votes(base_statistics(docs, id_col, text_col, carry), rules).withColumn("base_failed", failed)
    stats = stage(stats, "quality")
    names = [f"vote_{r.name}" for r in rules]
    # Documents already rejected would teach the rules nothing about the others.
    counts = stats.filter("NOT base_failed").groupBy(*names).count().collect()  # at most 3^rules rows
    prior, shares = fit_rules([(tuple(r[:-1]), r[-1]) for r in counts], len(rules))
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, s in zip(names, shares):
        good, none, bad = (_weight(v, *s) for v in (1, 0, -1))
        odds = odds + F.when(F.col(name) > 0, good).when(F.col(name) < 0, bad).otherwise(none)
    judged = stats.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))


def judge(docs, rules=RULES, keep_at=0.5, id_col="doc_id", text_col="text"):
    """One row per document: base statistics, ``base_failed``, ``posterior`` and ``kept``."""
    judged = _judged(docs, rules, keep_at, id_col, text_col, False)
    return judged.select("doc_id", *BASE_COLUMNS, "base_failed", *[f"vote_{r.name}" for r in rules], "posterior", "kept")


def keep_good(docs, rules=RULES, keep_at=0.5, id_col="doc_id", text_col="text"):
    """The rows of ``docs`` that are kept. They are staged with their statistics, so nothing is joined."""
    return _judged(docs, rules, keep_at, id_col, text_col, True).filter("kept").select("row.*")
