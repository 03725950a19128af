"""Licence scan: a trained paragraph classifier with template confirmation.

Paragraphs are the parts of a text between blank lines; each is judged as a
whole, so that a notice wrapped over lines is one, and, if it has several
lines, line by line, so that a notice within prose stands out. The classifier
is a sparse softmax regression over the hashed words and word pairs that occur
in licence texts (all others weigh nothing), against the class "unknown".

It is trained on names, notices and body sentences of public licences, whole,
in part, in usual surroundings and with words left out or put around, against
a bounded sample of ``SAMPLE`` paragraphs and lines of the corpus (from about
``SAMPLE_DOCS`` documents of any kind and as many that hold a licence word, those
of smallest text hash), less those that the templates confirm, and a few
phrases that hold licence words but name no licence. Half of the sample is held back and calibrates the
unknown class: a family is predicted only when its probability exceeds what
all but one in a thousand of those reach, and at least a half. The template
comparison then confirms the prediction: a name or sentence of the family is
found in the paragraph, or the paragraph is largely found in a sentence.

Every paragraph and line is scored. A first look adds up, word by word, the
most that any family could gain from it, a second one the most from the known
words and pairs at hand; where such a sum leaves no family a probability of a
half, the rest need not be computed. Only parts with a predicted family are
written, so the scratch space follows their number and not the input.

Only DataFrame functions run on the executors; the model is a few tables of
constants, trained on the driver from the bounded sample. The bound on the hash
follows from a first count, so what reaches the driver does not grow with the
tasks.

Defined cases: null and empty texts have no paragraphs. A paragraph is judged
by itself, so ties, repeats and other columns don't matter. An empty table
gives an empty result. Known limits, by choice: the name of a licence as a
word by itself in prose ("at MIT") is unknown; notices in languages other than
English are found by names only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, long_array, saved
from .license_templates import CARRIERS, NAMES, OTHER, SENTENCES

BUCKETS = 1 << 16
#: Corpus paragraphs and lines that stand for the unknown class, at most.
SAMPLE = 4_000
#: Documents that they are taken from, about, of each of two kinds; longer ones are scored, but not in the sample.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
#: Share of a sentence's word pairs that must be found in the paragraph, or of the paragraph's in a sentence.
CONFIRM = 0.7
#: Words of a paragraph that may be confirmed as a part of a longer sentence, at least.
PART_WORDS = 6
#: A score is divided by the root of the number of words, up to this many.
LONG = 64
STEPS = 250
MICRO = 1_000_000

FAMILIES = sorted(NAMES.keys() | SENTENCES.keys())
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
# Parts of words that licence texts often hold; they choose half of the sample and nothing else.
HINTS = ["licen[sc]", "copyright", "permission", "warrant", "redistribut", "public domain", "creative commons", "rights reserved", "proprietary"]
#: Names that are confirmed only beside a word that speaks of licences.
PLAIN_NAMES = ("mit", "isc", "unlicense", "gpl", "mpl")


def tokens(text: Column) -> Column:
    """Lower-cased words of letters, digits, dots and dashes inside; one spelling of "license"."""
    lower = F.replace(F.lower(text), F.lit("licence"), F.lit("license"))
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _tokens(text: str) -> list[str]:
    return re.findall(WORD, text.lower().replace("licence", "license"))


def pairs(ts: Column) -> Column:
    """Neighbouring words joined by a space."""
    first = F.slice(ts, 1, F.greatest(F.size(ts) - 1, F.lit(0)))
    return F.transform(first, lambda t, i: F.concat(t, F.lit(" "), F.get(ts, i + 1)))


def _pairs(ts: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(ts, ts[1:])]


def templates() -> dict[str, list[list[str]]]:
    """Per family the words of its names and sentences."""
    return {f: [_tokens(x) for x in NAMES.get(f, []) + SENTENCES.get(f, [])] for f in FAMILIES}


def examples(noise: list[list[str]]) -> tuple[list[list[str]], list[int]]:
    """Training paragraphs and their families: names in surroundings, sentences whole and in part, some with noise."""
    rng = np.random.default_rng(0)
    out, labels = [], []

    def add(k: int, words: list[str]) -> None:
        out.append(words)
        labels.append(k)
        kept = [w for w in words if rng.random() > 0.08] if len(words) > 5 else words
        around = noise[rng.integers(len(noise))] if noise else []
        cut = rng.integers(0, 9)
        out.append([*around[:cut], *kept, *around[cut : cut + rng.integers(0, 9)]])
        labels.append(k)

    for k, family in enumerate(FAMILIES):
        for name in NAMES.get(family, []):
            for carrier in CARRIERS:
                if carrier != "{}" or _tokens(name)[0] not in PLAIN_NAMES or len(_tokens(name)) > 1:
                    add(k, _tokens(carrier.format(name)))
        for sentence in SENTENCES.get(family, []):
            words = _tokens(sentence)
            for _ in range(6):
                add(k, words)
            for size in (10, 16, 24):
                for at in range(0, len(words) - size + 1, size // 2):
                    add(k, words[at : at + size])
    return out, labels


def paragraphs(text: Column) -> Column:
    """``paragraph`` (its number) and ``lines`` (the words of each line) of every paragraph that holds a word."""
    blocks = F.filter(F.split(text, r"\n(?:[\x20\x09-\x0D]*\n)+"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.transform(
        blocks, lambda x, i: F.struct(i.alias("paragraph"), F.transform(F.split(x, "\n"), tokens).alias("lines"))
    )


def units(docs: DataFrame) -> DataFrame:
    """``row``, ``paragraph`` and ``lines`` of every paragraph of ``docs`` (row, text)."""
    return docs.select("row", F.explode(paragraphs(F.col("text"))).alias("p")).select("row", "p.*")


def split_units(each: DataFrame) -> DataFrame:
    """``row, paragraph, line, ts``: every paragraph as a whole (line -1) and, of several lines, each line."""
    whole = F.struct(F.lit(-1).alias("line"), F.flatten("lines").alias("ts"))
    own = F.transform("lines", lambda ts, i: F.struct(i.alias("line"), ts.alias("ts")))
    parts = F.when(F.size("lines") > 1, F.concat(F.array(whole), own)).otherwise(F.array(whole))
    return each.select("row", "paragraph", F.explode(parts).alias("u")).select("row", "paragraph", "u.line", "u.ts").filter(
        F.size("ts") > 0
    )


def _norm(n: Column) -> Column:
    return F.sqrt(F.least(F.greatest(n, F.lit(1)), F.lit(LONG)).cast("double"))


@dataclass
class Model:
    """Buckets of the known n-grams, a weight per family and n-gram, and the probability a family must exceed."""

    where: np.ndarray  # bucket of each n-gram
    hashes: np.ndarray  # and its whole hash, so that other n-grams of the bucket weigh nothing
    weights: np.ndarray  # family x n-gram, in millionths
    bias: np.ndarray
    floors: list[float]
    most: np.ndarray  # per word the most any family gains from it and from the pairs counted with it

    def number(self, h: Column) -> Column:
        """1-based number of the known n-gram of a hash, 0 for others."""
        table = np.zeros(BUCKETS, np.int64)
        table[self.where] = np.arange(1, len(self.where) + 1)
        i = F.get(long_array(table), h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("int")
        return F.when(F.get(long_array([0, *self.hashes]), i) == h, i).otherwise(0)

    def gain(self, ts: Column) -> Column:
        """What the words and their pairs add to any family's score, at most (in millionths, before the division)."""
        most = long_array([0, *self.most])
        return F.aggregate(F.transform(ts, lambda t: F.xxhash64(t)), F.lit(0).cast("bigint"), lambda n, h: n + F.get(most, self.number(h)))

    def reach(self, gain: Column, n: Column) -> Column:
        """No less than any family's score of ``n`` words with that gain."""
        return gain / MICRO / _norm(n) + float(self.bias.max())

    def bound(self, ts: Column) -> Column:
        """No less than any family's score of the words."""
        return self.reach(self.gain(ts), F.size(ts))

    def _grams(self, ts: Column) -> Column:
        """Numbers of the known words and pairs."""

        def pair_ids(own: Column) -> Column:
            # a known pair has two known words
            both = lambda i: (F.get(own, i) > 0) & (F.get(own, i + 1) > 0)
            pair = lambda t, i: F.concat(t, F.lit(" "), F.get(ts, i + 1))
            return F.transform(ts, lambda t, i: F.when(both(i), self.number(F.xxhash64(pair(t, i)))).otherwise(0))

        words = F.transform(F.transform(ts, lambda t: F.xxhash64(t)), self.number)
        return _once(words, lambda own: F.filter(F.concat(own, pair_ids(own)), lambda i: i > 0))

    def _scores(self, own: Column, n: Column) -> Column:
        """Score of each family, from the known n-grams of ``n`` words."""
        lists = [long_array([0, *row]) for row in self.weights]
        return F.array(
            *[
                F.aggregate(own, F.lit(0).cast("bigint"), _adder(t)) / MICRO / _norm(n) + float(b)
                for t, b in zip(lists, self.bias, strict=True)
            ]
        )

    def scores(self, ts: Column) -> Column:
        """Score of each family against the unknown class."""
        return _once(self._grams(ts), lambda own: self._scores(own, F.size(ts)))

    def family(self, ts: Column) -> Column:
        """The family predicted for the words; null: unknown.

        Only where the n-grams at hand, each counted with its greatest weight,
        leave a family a probability of a half are the families' scores added up.
        """
        best = long_array([0, *self.weights.max(axis=0)])
        named = F.array(*[F.lit(f) for f in FAMILIES])
        floor = F.array(*[F.lit(f) for f in self.floors])

        def named_by(z: Column) -> Column:
            def likely(top: Column) -> Column:
                # no score below 0 has a probability of a half, so none is lost
                prob = F.lit(1.0) / F.aggregate(z, F.exp(-top), lambda n, x: n + F.exp(x - top))
                k = F.array_position(z, top).cast("int") - 1
                return F.when((top >= 0) & (prob >= F.get(floor, k)), F.get(named, k))

            return _once(F.array_max(z), likely)

        def judged(own: Column) -> Column:
            most = F.aggregate(own, F.lit(0).cast("bigint"), _adder(best))
            return F.when(self.reach(most, F.size(ts)) >= 0, _once(self._scores(own, F.size(ts)), named_by))

        return _once(self._grams(ts), judged)


def _once(value: Column, f) -> Column:
    """``f`` of an array that is computed once, not once per use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _adder(table: Column):
    return lambda n, g: n + F.get(table, g)


def _hashed(spark, grams: list[str]) -> dict[str, int]:
    """N-grams and their hashes, by the engine's own function."""
    rows = spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.xxhash64("g").alias("h")).collect()
    return {r["g"]: r["h"] for r in rows}


def _sample(docs: DataFrame) -> list[list[str]]:
    """Words of at most ``SAMPLE`` distinct paragraphs and lines, from documents of small text hash.

    Half of the documents are taken from all, half from those that hold one
    of ``HINTS`` (where there are any).
    """
    short = docs.filter(F.length("text").between(1, SAMPLE_CHARS))
    hint = F.lower("text").rlike("|".join(HINTS))
    n, hinted = short.agg(F.count(F.lit(1)), F.count_if(hint)).first()
    at = F.pmod(F.xxhash64("text"), F.lit(1 << 32))

    def below(many: int) -> Column:
        return at < int(min(1.0, SAMPLE_DOCS / max(many, 1)) * (1 << 32))

    some = short.filter(below(n) | (below(hinted) & hint))
    parts = split_units(units(some)).select(F.array_join("ts", " ").alias("x")).distinct()
    # about 2 * SAMPLE_DOCS short texts' parts
    rows = parts.orderBy(F.xxhash64("x"), "x").limit(SAMPLE).collect()
    return [r["x"].split(" ") for r in rows]


def train(docs: DataFrame) -> Model:
    """Fit the classifier; ``docs`` (row, text) give the unknown class."""
    rng = np.random.default_rng(1)
    known = templates()
    corpus = [ts for ts in _sample(docs) if not any(_confirmed(ts, known[f]) for f in FAMILIES)]
    order = rng.permutation(len(corpus))
    held, unknown = [corpus[i] for i in order[1::2]], [corpus[i] for i in order[::2]]
    texts, labels = examples(unknown)
    other = [_tokens(x) for x in OTHER] + [_tokens(c.format("")) for c in CARRIERS]
    unknown += [x for x in other for _ in range(4)]
    grams = sorted({g for ts in known.values() for t in ts for g in t + _pairs(t)} | {g for c in CARRIERS for g in _tokens(c.format(""))})
    known_grams = _hashed(docs.sparkSession, grams)
    # of n-grams that share a bucket only the first is known
    first: dict[int, str] = {}
    for g in grams:
        first.setdefault(known_grams[g] & (BUCKETS - 1), g)
    # and a pair only with both of its words
    first = {b: g for b, g in first.items() if all(first.get(known_grams[t] & (BUCKETS - 1)) == t for t in g.split(" "))}
    where = np.array(sorted(first))
    column = {first[b]: i for i, b in enumerate(where.tolist())}

    def matrix(items: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(items), len(where)), np.float32)
        for i, ts in enumerate(items):
            at = [column[g] for g in ts + _pairs(ts) if g in column]
            np.add.at(x[i], at, 1 / np.sqrt(min(max(len(ts), 1), LONG)))
        return x

    k = len(FAMILIES)
    x = np.concatenate([matrix(texts), matrix(unknown)])
    y = np.array(labels + [k] * len(unknown))
    count = np.bincount(y, minlength=k + 1)
    # the families share half of the weight, the unknown class has the other
    weight = np.where(y == k, 0.5 / max(count[k], 1), 0.5 / k / np.maximum(count[y], 1)).astype(np.float32)
    w, b = _fit(x, y, weight, k)
    reach = _probabilities(matrix(held) @ w.T + b) if held else np.zeros((0, k))
    floors = [max(0.5, float(np.quantile(reach[:, i], 0.999)) if len(reach) else 0.5) for i in range(k)]
    micro = np.rint(w * MICRO).astype(np.int64)
    most = _most(micro, column, held)
    return Model(where, np.array([known_grams[first[b]] for b in where.tolist()]), micro, b, floors, most)


def _most(weights: np.ndarray, column: dict[str, int], corpus: list[list[str]]) -> np.ndarray:
    """Per word its own greatest weight and, if they gain, those of the pairs counted with it (with their rarer word)."""
    seen: dict[str, int] = {}
    for ts in corpus:
        for t in set(ts):
            seen[t] = seen.get(t, 0) + 1
    out = weights.max(axis=0)
    after: dict[int, dict[str, int]] = {}
    for g, i in column.items():
        if " " not in g:
            continue
        rare = min(g.split(" "), key=lambda t: (seen.get(t, 0), t))
        best = after.setdefault(column[rare], {"left": 0, "right": 0})
        side = "right" if g.startswith(rare + " ") else "left"
        best[side] = max(best[side], int(weights[:, i].max()))
    for i, best in after.items():
        # a word stands in one pair on each side
        out[i] += best["left"] + best["right"]
    return out


def _probabilities(z: np.ndarray) -> np.ndarray:
    """Of each family, the unknown class having score 0."""
    top = np.maximum(z.max(axis=1, keepdims=True), 0)
    e = np.exp(z - top)
    return e / (e.sum(axis=1, keepdims=True) + np.exp(-top))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression with the unknown class (``k``) at score 0, by accelerated proximal steps that keep weights sparse."""
    target = np.zeros((len(y), k), np.float32)
    target[np.flatnonzero(y < k), y[y < k]] = 1
    w, b = np.zeros((k, x.shape[1]), np.float32), np.full(k, -1.0, np.float32)
    grown_w, grown_b = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    for _ in range(STEPS):
        error = (target - _probabilities(x @ w.T + b)) * weight[:, None]
        step_w, step_b = error.T @ x, error.sum(axis=0)
        grown_w += step_w**2
        grown_b += step_b**2
        w += 0.5 * step_w / np.sqrt(grown_w)
        b += 0.1 * step_b / np.sqrt(grown_b)
        w = np.sign(w) * np.maximum(np.abs(w) - 1e-3, 0)
    return w, b


def _confirmed(ts: list[str], known: list[list[str]]) -> bool:
    """``confirmed`` for one paragraph in plain code (used on the sample)."""
    mine = set(_pairs(ts))
    for words in known:
        if len(words) == 1:
            if words[0] in ts and (words[0] not in PLAIN_NAMES or any("licens" in t for t in ts)):
                return True
            continue
        theirs = set(_pairs(words))
        shared = len(mine & theirs)
        if shared >= CONFIRM * len(theirs) or (len(ts) >= PART_WORDS and len(words) > PART_WORDS and shared >= CONFIRM * len(mine)):
            return True
    return False


def confirmed(ts: Column, family: Column) -> Column:
    """Whether a name or sentence of the family is found in the paragraph, or the paragraph largely in a sentence."""
    mine = F.array_distinct(pairs(ts))
    speaks = F.exists(ts, lambda t: F.contains(t, F.lit("licens")))
    out = F.lit(False)
    for name, known in templates().items():
        found = F.lit(False)
        for words in known:
            if len(words) == 1:
                hit = F.array_contains(ts, words[0])
                found = found | ((hit & speaks) if words[0] in PLAIN_NAMES else hit)
                continue
            theirs = sorted(set(_pairs(words)))
            shared = F.size(F.array_intersect(mine, F.array(*[F.lit(p) for p in theirs])))
            found = found | (shared >= CONFIRM * len(theirs))
            if len(words) > PART_WORDS:
                found = found | ((F.size(ts) >= PART_WORDS) & (shared >= F.size(mine) * CONFIRM))
        out = out | ((family == name) & found)
    return F.coalesce(out, F.lit(False))


def open_parts(model: Model, lines: Column) -> Column:
    """``line`` and ``ts`` of the parts of a paragraph (``split_units``) that can reach a probability of a half."""
    each = F.transform(
        lines, lambda ts, i: F.struct(i.alias("line"), ts.alias("ts"), model.gain(ts).alias("gain"), F.size(ts).alias("n"))
    )

    def open_(parts: Column) -> Column:
        total = lambda name: F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, x: n + x[name])
        whole = F.struct(F.lit(-1).alias("line"), F.flatten(F.transform(parts, lambda x: x["ts"])).alias("ts"))
        own = F.filter(parts, lambda x: (F.size(parts) > 1) & (x["n"] > 0) & (model.reach(x["gain"], x["n"]) >= 0))
        own = F.transform(own, lambda x: F.struct(x["line"].alias("line"), x["ts"].alias("ts")))
        reached = (total("n") > 0) & (model.reach(total("gain"), total("n")) >= 0)
        return F.when(reached, F.concat(F.array(whole), own)).otherwise(own)

    return _once(each, open_)


def named_parts(model: Model, blocks: Column) -> Column:
    """``paragraph, line, ts, family`` of the parts of a text's paragraphs that the classifier gives a family."""

    def of(block: Column) -> Column:
        parts = F.transform(
            open_parts(model, block["lines"]),
            lambda u: F.struct(
                block["paragraph"].alias("paragraph"),
                u["line"].alias("line"),
                u["ts"].alias("ts"),
                model.family(u["ts"]).alias("family"),
            ),
        )
        return F.filter(parts, lambda x: x["family"].isNotNull())

    return F.flatten(F.transform(blocks, of))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_licensed, families, and lines (paragraph:family, joined).

    A line's family counts for its paragraph; the family of the paragraph as
    a whole counts where no line of it names one.
    """
    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    model = train(rows)
    # row numbers and predictions are written together, from one reading and once for all families they are
    # confirmed for; of the texts only the parts that a family was predicted for are written
    read = rows.select("row", "doc_id", paragraphs(F.col("text")).alias("all"))
    table = saved(
        read.select("row", "doc_id", F.size("all").cast("bigint").alias("n_paragraphs"), named_parts(model, F.col("all")).alias("named")),
        "licence-named",
    )
    named = table.select("row", F.explode("named").alias("p")).select("row", "p.*")
    found = named.filter(confirmed(F.col("ts"), F.col("family")))
    best = found.groupBy("row", "paragraph").agg(
        F.max(F.col("line") >= 0).alias("by_line"),
        F.collect_set(F.struct((F.col("line") >= 0).alias("is_line"), "family")).alias("all"),
    )
    named = best.select(
        "row", "paragraph", F.explode(F.filter("all", lambda x: x["is_line"] == F.col("by_line"))).alias("x")
    ).select("row", "paragraph", "x.family")
    per_row = named.groupBy(F.col("row").alias("r")).agg(
        F.count_distinct("paragraph").alias("n_licensed"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
        F.sort_array(F.collect_list(F.struct("paragraph", "family"))).alias("at"),
    )
    shown = F.array_join(F.transform("at", lambda x: F.concat_ws(":", x["paragraph"], x["family"])), ",")
    return table.join(per_row, F.col("row") == F.col("r"), "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("n_licensed", F.lit(0)).cast("bigint").alias("n_licensed"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.coalesce(shown, F.lit("")).alias("lines"),
    )
