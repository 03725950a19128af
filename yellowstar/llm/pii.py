"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of one pattern per kind (email, ip, card, phone)
and of wider ones (spelled-out addresses, national phone numbers). Labelers
vote on each candidate: the base format, a check of the value, a gazetteer,
cue words in the context, and the characters at its edges. Votes are counted
by pattern (at most ``3**5`` patterns a kind, whatever the corpus);
expectation-maximisation over those counts estimates how reliable each labeler
is, and the posterior of each pattern trains the final span classifier, a
naive Bayes over hashed features of span and context (``BUCKETS`` weights).

A base match that passes its check is always a span. The classifier adds
further candidates that it holds for personal data with probability
``ADDED_FROM`` or more and that do not overlap a base span.

Positions are code points, end exclusive. They are running sums of the
lengths of the gaps and matches of a text, taken over exploded candidates, so
the work is linear in the text.

Patterns are written with possessive quantifiers and look-behinds that find
the same leftmost matches in linear time on long runs.

Defined cases: null and empty texts have no spans. Rows are independent, so
ties and repeated rows have equal results. Without candidates nothing is
trained and nothing added. An empty table gives an empty result. ``redact``
leaves null texts null and other columns untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, long_array, saved
from .weak_labels import estimate

KINDS = ["email", "ip", "card", "phone"]
BUCKETS = 1024
ADDED_FROM = 0.9
CONTEXT = 24

# The base patterns of each kind, made linear.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns whose matches need the classifier's consent.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
#: A text without this part has no match of the pattern (a cheap test before the pattern).
NEEDS = {("email", True): "@", ("phone", True): "+", ("email", False): "at"}

# Gazetteers and cue words of the labelers.
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "eu", "us", "ch", "at"]
ISSUERS = ["4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "36", "35", "62"]
CUES = {
    "email": ["mail", "contact", "write", "reach", "correo", "courriel", "kontakt"],
    "ip": ["ip", "host", "server", "address", "login", "client"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "fax", "whatsapp", "telefon"],
}
ANTI_CUES = ["version", "isbn", "section", "release", "item", "page", "serial"]


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether up to 20 digits pass the Luhn check."""
    full = F.lpad(d, 20, "0")
    total = F.lit(0)
    for i in range(20):
        c = F.substring(full, i + 1, 1)
        total = total + (F.translate(c, "0123456789", "0246813579") if i % 2 == 0 else c).cast("int")
    return total % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """The base check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits(m))).otherwise(False)
    return n.between(10, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _any_word(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike(r"(?:^|[^a-z])(?:" + "|".join(words) + ")")


def votes(kind: str, base: bool, m: Column, left: Column, right: Column) -> list[Column]:
    """The five labelers' votes on a candidate: 1 personal, -1 not, 0 no opinion."""
    d = digits(m)
    passes = valid(kind, m) if base else F.lit(False)
    if kind == "email":
        top = F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1))
        value = _vote(F.length(top).between(2, 24), F.length(top) < 2)
        known = _vote(top.isin(TOP_DOMAINS), F.lit(False))
    elif kind == "ip":
        value = _vote(passes & ~m.rlike(r"(?:^|\.)0[0-9]"), ~passes)
        known = _vote(F.lit(False), m.rlike(r"^(?:0|10|127|192\.168|255)\."))
    elif kind == "card":
        value = _vote(F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False), ~F.length(d).between(14, 19))
        known = _vote(reduce(lambda a, b: a | b, [d.startswith(p) for p in ISSUERS]), F.lit(False))
    else:
        value = _vote(F.length(d).between(10, 15), ~F.length(d).between(7, 15))
        known = _vote(d.rlike("^(?:1?[2-9][0-9]{2}[2-9]|33|34|44|49)"), d.rlike("^0+$"))
    return [
        _vote(passes, ~passes),
        value,
        known,
        _vote(_any_word(left, CUES[kind]), _any_word(left, ANTI_CUES)),
        _vote(
            ~left.rlike(r"[\p{L}\p{N}]$") & ~right.rlike(r"^[\p{L}\p{N}]"),
            left.rlike(r"[\p{L}\p{N}]$") | right.rlike(r"^[\p{L}\p{N}]"),
        ),
    ]


def features(kind: str, base: bool, m: Column, left: Column, right: Column) -> Column:
    """Hashed features of a candidate: shape, sizes and neighbouring words, each with its kind."""
    shape = F.substring(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), r"\p{L}+", "a"), 1, 12)
    parts = [
        F.lit(f"{kind}{int(base)}"),
        shape,
        F.length(digits(m)).cast("string"),
        F.least(F.length(m), F.lit(40)).cast("string"),
        F.lower(F.regexp_extract(left, r"(\p{L}+)[^\p{L}]*$", 1)),
        F.substring(right, 1, 1),
    ]
    return F.array(
        *[
            F.xxhash64(F.concat(F.lit(f"{i}:{kind}:"), p)).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
            for i, p in enumerate(parts)
        ]
    )


def _matches(text: Column, pattern: str, needs: str | None) -> tuple[Column, Column]:
    """Gaps and matches of a pattern; a text without the needed part is one gap."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needs is None:
        return gaps, found
    has = F.contains(text, F.lit(needs))
    return F.when(has, gaps).otherwise(F.array(text)), F.when(has, found).otherwise(F.array().cast("array<string>"))


def _patterns() -> list[tuple[str, bool, str]]:
    return [(k, True, BASE[k]) for k in KINDS] + [(k, False, WIDE[k]) for k in KINDS if k in WIDE]


def _tail(gap: Column) -> Column:
    return F.right(gap, F.lit(CONTEXT))


def candidates(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, text) with ``found``: per pattern the matches with gap length and context."""
    out, lists = rows, []
    for j, (kind, base, pattern) in enumerate(_patterns()):
        gaps, found = _matches(F.col("text"), pattern, NEEDS.get((kind, base)))
        out = out.withColumns({f"gaps{j}": gaps, f"hits{j}": found})
        lists.append(F.transform(f"hits{j}", _candidate(j, kind, base, F.col(f"gaps{j}"))))
    return out.select(*[c for c in rows.columns if c != "text"], F.flatten(F.array(*lists)).alias("found"))


def _candidate(j: int, kind: str, base: bool, gaps: Column):
    """The struct of the i-th match of pattern ``j``."""

    def one(m: Column, i: Column) -> Column:
        left, right = _tail(F.get(gaps, i)), F.substring(F.get(gaps, i + 1), 1, 8)
        return F.struct(
            F.lit(j).alias("pattern"),
            i.alias("i"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(m).alias("size"),
            (F.lit(base) & valid(kind, m)).alias("base"),
            F.array(*votes(kind, base, m, left, right)).alias("votes"),
            features(kind, base, m, left, right).alias("features"),
        )

    return one


@dataclass
class Model:
    """Reliabilities by kind, and the classifier's weights in millionths."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, list[tuple[float, float]]] = field(default_factory=dict)
    posterior: dict[tuple[str, tuple[int, ...]], float] = field(default_factory=dict)
    bias: dict[str, int] = field(default_factory=dict)
    weights: list[int] = field(default_factory=lambda: [0] * BUCKETS)


def train(found: DataFrame) -> Model:
    """Fit reliabilities and classifier on every candidate (``found`` has one row each)."""
    kinds = [k for k, _, _ in _patterns()]
    model = Model()
    tally = found.groupBy("pattern", "votes").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the patterns
    by_kind: dict[str, dict[tuple[int, ...], int]] = {}
    for row in tally:
        counts = by_kind.setdefault(kinds[row["pattern"]], {})
        counts[tuple(row["votes"])] = counts.get(tuple(row["votes"]), 0) + row["n"]
    for kind, counts in by_kind.items():
        model.prior[kind], model.reliability[kind], post = estimate(counts)
        model.posterior |= {(kind, p): x for p, x in post.items()}
    if not by_kind:
        return model
    soft = F.lit(0.0)
    for (kind, pattern), x in model.posterior.items():
        same = F.col("pattern").isin([j for j, k in enumerate(kinds) if k == kind])
        soft = F.when(same & (F.col("votes") == F.array(*[F.lit(v) for v in pattern])), F.lit(round(x * 1e6))).otherwise(soft)
    grouped = (
        found.groupBy("pattern", "votes", "features")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("soft", soft.cast("bigint"))
        .select("n", "soft", F.explode("features").alias("f"))
        .groupBy("f")
        .agg(F.sum(F.col("n") * F.col("soft")).alias("yes"), F.sum("n").alias("n"))
        .collect()  # at most BUCKETS rows
    )
    total = {k: sum(c.values()) for k, c in by_kind.items()}
    yes = {k: sum(n * model.posterior[k, p] for p, n in c.items()) for k, c in by_kind.items()}
    model.bias = {k: round(1e6 * math.log((yes[k] + 1) / (total[k] - yes[k] + 1))) for k in total}
    overall = math.log((sum(yes.values()) + 1) / (sum(total.values()) - sum(yes.values()) + 1))
    for row in grouped:
        y = row["yes"] / 1e6
        model.weights[row["f"]] = round(1e6 * (math.log((y + 1) / (row["n"] - y + 1)) - overall))
    return model


def accepted(model: Model, kind: Column | str, feats: Column) -> Column:
    """Whether the classifier takes a candidate for personal data."""
    table = long_array(model.weights)
    bias = F.lit(model.bias.get(kind, -(10**9)))
    total = F.aggregate(feats, bias.cast("bigint"), lambda n, f: n + F.get(table, f))
    return total >= round(1e6 * math.log(ADDED_FROM / (1 - ADDED_FROM)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, counts per kind, base_sha256, spans, and n_added."""
    table = saved(candidates(_rows(docs, id_col, text_col)), "candidates")
    each = table.select("row", F.explode("found").alias("x")).select("row", "x.*")
    model = train(each)
    sofar = Window.partitionBy("row", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(sofar)
    kinds = [k for k, _, _ in _patterns()]
    take: Column = F.lit(False)
    for j, kind in enumerate(kinds):
        take = F.when(F.col("pattern") == j, accepted(model, kind, F.col("features"))).otherwise(take)
    spans = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    order: Column = F.lit(0)
    for j, kind in enumerate(kinds):
        order = F.when(F.col("pattern") == j, KINDS.index(kind)).otherwise(order)
    spans = spans.select("row", "start", order.alias("kind"), "end", "base", (~F.col("base") & take).alias("added"))
    spans = spans.filter("base or added")
    # running values in one order and in its reverse: the work is linear in the spans of a text
    order_by = [F.col(c) for c in ("start", "kind", "end", "base")]
    forth = Window.partitionBy("row").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(*[c.desc() for c in order_by]).rowsBetween(Window.unboundedPreceding, -1)
    before = F.max(F.when(F.col("base"), F.col("end"))).over(forth)
    behind = F.min(F.when(F.col("base"), F.col("start"))).over(back)
    clear = ~F.coalesce(before > F.col("start"), F.lit(False)) & ~F.coalesce(behind < F.col("end"), F.lit(False))
    spans = spans.withColumn("clear", clear).filter("base or clear").dropDuplicates(["row", "start", "kind", "end"])
    per_row = spans.groupBy(F.col("row").alias("r")).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("all")
    )
    out = table.select("row", "doc_id").join(per_row, F.col("row") == F.col("r"), "left")
    out = out.withColumn("all", F.coalesce("all", F.array().cast(per_row.schema["all"].dataType)))
    names = F.array(*[F.lit(k) for k in KINDS])

    def text_of(items: Column) -> Column:
        return F.array_join(
            F.transform(items, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
        )

    base = F.filter("all", lambda s: s["base"])
    return out.select(
        "doc_id",
        *[
            F.size(F.filter("all", _base_of(k))).cast("bigint").alias(f"n_{kind}")
            for k, kind in enumerate(KINDS)
        ],
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: ~s["base"])).cast("bigint").alias("n_added"),
    )


def _base_of(k: int):
    return lambda s: s["base"] & (s["kind"] == k)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>``.

    The base spans of all kinds go first; the classifier judges what matches in the text that is left.
    """
    found = candidates(_rows(docs, id_col, text_col)).select(F.explode("found").alias("x"))
    model = train(saved(found.select("x.pattern", "x.votes", "x.features"), "candidates"))
    names = {"text": "redact_text", "gaps": "redact_gaps", "hits": "redact_hits"}
    out = docs.withColumn(names["text"], F.coalesce(docs[text_col].cast("string"), F.lit("")))
    passes = [(p, None) for p in _patterns() if p[1]] + [(p, model) for p in _patterns()]
    for (kind, base, pattern), judge in passes:
        gaps, hits = _matches(F.col(names["text"]), pattern, NEEDS.get((kind, base)))
        out = out.withColumns({names["gaps"]: gaps, names["hits"]: hits})
        out = out.withColumn(names["text"], _replaced(kind, base, judge, names))
    return out.select(
        *[
            F.when(docs[c].isNotNull(), F.col(names["text"])).alias(c) if c == text_col else docs[c]
            for c in docs.columns
        ]
    )


def _replaced(kind: str, base: bool, model: Model | None, names: dict[str, str]) -> Column:
    """The gaps joined again; between them the matches, replaced if valid (no model) or accepted by the model."""
    gaps, hits = F.col(names["gaps"]), F.col(names["hits"])
    mark = F.lit(f"<{kind.upper()}>")

    def one(gap: Column, i: Column) -> Column:
        m = F.get(hits, i)
        if model is None:
            take = valid(kind, m)
        else:
            right = F.substring(F.get(gaps, i + 1), 1, 8)
            take = accepted(model, kind, features(kind, base, m, _tail(gap), right))
        return F.concat(gap, F.when(m.isNull(), "").when(take, mark).otherwise(m))

    return F.when(F.size(hits) == 0, F.col(names["text"])).otherwise(F.array_join(F.transform(gaps, one), ""))
