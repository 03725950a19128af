"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document (length, symbols, word
lengths, capitals, repeated windows, repeated lines, echoed words, distinct words, stop
words, plain words).
The votes are counted by pattern over all documents (at most ``3**10``
patterns); expectation-maximisation estimates how accurate each labeller is
and the posterior of each pattern. Posterior labels train a linear scorer over
hashed words, word pairs, word endings and echoed words, fitted on a bounded sample of
``SAMPLE`` documents of each side (those of smallest hash of id and text, of at
most ``SAMPLE_CHARS`` characters); every document is scored by it.

Defined cases: null and empty texts have no words and score 0. Rows that share
an id, or have none, are labelled each by its own text; rows equal in both
are one in the sample. If all
documents fall on one side there is nothing to separate: the scorer is
constant and the posterior alone decides. Rows are independent; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality_rules
from .bpe import span_hashes
from .common import id_text, map_texts, saved
from .shingles import mix, word_spans
from .weak_labels import estimate

BUCKETS = 1 << 15
#: Documents of each side that the scorer is fitted on, at most.
SAMPLE = 2_500
#: Characters of a text that the scorer may be fitted on; longer ones are scored, but not in the sample.
SAMPLE_CHARS = 50_000
STEPS = 60
#: First guesses: share of good documents, and how often a labeller is right on good and on bad ones
#: (a bad document shows in a few labellers only, each knows one kind of it).
START = (0.85, 0.97, 0.4)
#: Probability of good text from which a document is kept.
KEEP_FROM = 0.05

# Frequent function words of the corpus' languages.
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "that", "for", "it", "on", "with", "was",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ein", "eine", "ist",
    "de", "la", "le", "les", "des", "et", "que", "un", "une", "est", "pour", "dans",
    "el", "los", "las", "en", "y", "se", "del", "por", "con", "para",
]


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id and the votes of every document of ``docs`` (doc_id, text)."""
    counted = quality_rules.with_word_hashes(docs)
    plain = F.size(F.filter("ws", lambda w: w.rlike(r"^\p{L}+[,.;:!?)]?$")))
    stops = F.size(F.filter("ws", lambda w: F.lower(w).isin(STOP_WORDS)))
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: x != ""))
    counted = counted.select(
        F.struct(
            "doc_id",
            plain.alias("plain"),
            stops.alias("stops"),
            lines.alias("lines"),
            F.size(F.array_distinct("hs")).alias("kinds"),
            F.size(F.filter("hs", lambda h, i: h == F.get("hs", i - 1))).alias("echoes"),
            F.regexp_count("text", F.lit(r"\p{Lu}")).alias("capitals"),
        ).alias("doc_id"),
        "text",
        "ws",
        "hs",
    )
    x = quality_rules.base_counts(counted).withColumnRenamed("doc_id", "own").select("own.*", "*")
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))

    def share(a: str) -> Column:
        return F.col(a) / n

    votes = [
        _vote(F.col("n_words") >= 50, F.col("n_words") < 5),
        _vote(share("n_symbols") < 0.02, share("n_symbols") > 0.1),
        _vote(F.col("word_chars") / n <= 9, (F.col("word_chars") / n > 14) | (F.col("word_chars") / n < 2)),
        _vote(F.col("capitals") / chars < 0.15, F.col("capitals") / chars > 0.4),
        _vote(share("n_repeat_words") < 0.1, share("n_repeat_words") > 0.4),
        _vote(F.col("n_dup_lines") / F.greatest("lines", F.lit(1)) < 0.1, F.col("n_dup_lines") / F.greatest("lines", F.lit(1)) > 0.3),
        _vote(share("echoes") < 0.05, share("echoes") > 0.2),
        _vote((share("kinds") > 0.3) | (F.col("kinds") > 200), share("kinds") < 0.1),
        _vote(share("stops") >= 0.05, share("stops") < 0.02),
        _vote(share("plain") >= 0.9, share("plain") < 0.7),
    ]
    return x.select("doc_id", F.array(*votes).alias("votes"))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the texts' words, pairs and endings, and the text of each feature."""
    cp, starts, lens, owner = word_spans(texts)
    words = mix(span_hashes(cp, starts, lens))
    tail = np.minimum(lens, 3)
    ends = mix(span_hashes(cp, starts + lens - tail, tail) ^ np.uint64(3))
    same = owner[1:] == owner[:-1]
    pairs = mix(words[:-1] ^ mix(words[1:]))[same] if len(words) else words
    second = owner[1:][same] if len(owner) else owner
    # a word that follows itself is a feature of its own, whatever the word
    echo = np.flatnonzero(words[1:][same] == words[:-1][same]) if len(words) else np.zeros(0, np.int64)
    every = np.concatenate([words, pairs, ends, np.full(len(echo), mix(np.zeros(1, np.uint64))[0])])
    owners = np.concatenate([owner, second, owner, second[echo]])
    return (every & np.uint64(BUCKETS - 1)).astype(np.int32), owners


def fit(buckets: np.ndarray, owners: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on feature shares, by adaptive gradient steps over the whole sample."""
    n = len(labels)
    size = np.maximum(np.bincount(owners, minlength=n), 1)
    weights, bias = np.zeros(BUCKETS), 0.0
    grown = np.full(BUCKETS, 1e-8)
    value = 1.0 / np.sqrt(size)[owners]
    for _ in range(STEPS):
        z = np.bincount(owners, weights=weights[buckets] * value, minlength=n) + bias
        error = labels - 1 / (1 + np.exp(-z))
        step = np.bincount(buckets, weights=error[owners] * value, minlength=BUCKETS) / n - 1e-5 * weights
        grown += step**2
        weights += 0.3 * step / np.sqrt(grown)
        bias += 0.5 * error.mean()
    return weights, bias


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, score (probability of good text) and kept."""
    # a row's mark tells its id and text: rows that share an id are sampled each for itself
    rows = id_text(docs, id_col, text_col).withColumn("mark", F.xxhash64(F.lit(1), "doc_id", "text"))
    voted = labelled(rows.select(F.struct("doc_id", "mark", F.length("text").alias("chars")).alias("doc_id"), "text"))
    voted = saved(voted.select("doc_id.mark", "doc_id.chars", "votes"), "votes")
    tally = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the patterns
    counts = {tuple(r["votes"]): r["n"] for r in tally}
    weights, bias = np.zeros(BUCKETS), 0.0
    if counts:
        _, _, post = estimate(counts, start=START)
        good = [F.array(*[F.lit(v) for v in p]) for p, x in post.items() if x >= 0.5]
        side = F.col("votes").isin(good) if good else F.lit(False)
        marked = voted.filter(F.col("chars") <= SAMPLE_CHARS).select("mark", side.alias("good")).distinct()
        picked = None
        for value in (True, False):
            part = marked.filter(F.col("good") == value).orderBy(F.xxhash64("mark"), "mark").limit(sample)
            picked = part if picked is None else picked.union(part)
        # at most 2 * sample marks; rows equal in id and text are one
        bounded = F.broadcast(picked.select(F.col("mark").alias("p"), "good"))
        chosen = rows.join(bounded, F.col("mark") == F.col("p")).dropDuplicates(["mark"]).select(
            F.col("good").cast("int").alias("doc_id"), "text"
        )

        def run(texts):
            b, o = grams(texts)
            count = np.bincount(o, minlength=len(texts))
            return None, {"b": np.split(b[np.argsort(o, kind="stable")], np.cumsum(count)[:-1])}

        data = map_texts(chosen, run, "b array<int>").toArrow()
        labels = data.column("doc_id").to_numpy().astype(float)
        lists = data.column("b").to_pylist()
        if 0 < labels.sum() < len(labels):
            owners = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            weights, bias = fit(np.concatenate([np.asarray(x, np.int32) for x in lists]), owners, labels)
        else:
            bias = 20.0 if len(labels) and labels.all() else -20.0
    return score(docs, weights.astype(np.float32), bias, id_col, text_col)


def score(docs: DataFrame, weights: np.ndarray, bias: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's score by the linear scorer; texts without words score 0."""

    def run(texts):
        b, o = grams(texts)
        size = np.bincount(o, minlength=len(texts))
        z = np.bincount(o, weights=weights[b].astype(float), minlength=len(texts)) / np.sqrt(np.maximum(size, 1)) + bias
        p = np.where(size > 0, 1 / (1 + np.exp(-z)), 0.0)
        return None, {"score": p, "kept": p >= KEEP_FROM}

    return map_texts(docs, run, "score double, kept boolean", id_col, text_col)
