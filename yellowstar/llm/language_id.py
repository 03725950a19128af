"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree of order three: for every
context of up to three bytes, how often each byte followed. A byte costs
``-log2 n / (total + distinct)`` bits in the longest context that has seen it;
each longer context that has not costs an escape of
``-log2 distinct / (total + distinct)`` bits; a byte that no context knows
costs eight bits more. A text's code length under a language is the sum over
its bytes, with the statistics frozen (a text does not teach the trees). The
language that codes the text in the fewest bits is predicted. Costs are whole
multiples of 2**-16 bit, so sums are exact and do not depend on the order or the
grouping of texts.

The counts come from every training text as a whole: tasks count four-byte
windows by language, the counts are added up, and the lower orders follow from
them. Trees are frequency-bound: together they have about ``MAX_NODES``
windows, shared equally by the languages; the most frequent stay (by count in steps
of an eighth of an octave; within the last step by the window's hash). This
bounds what reaches the driver and travels with the tasks.

Training reads texts with a language whose crc32(id as text) mod 4 is not 2.
The prediction reads nothing but the text.

Defined cases: a null text and one without a letter are ``und`` with score 0,
as is every text when nothing could be learned. A null id has no remainder: it
is not held out and teaches nothing. Repeated rows count each. Ties of code
length go to the least language name. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, saved, ship_package, text_batches

#: Bytes of a window: a context of three bytes and the byte that follows.
WIDTH = 4
#: Windows of all languages together that the trees keep.
MAX_NODES = 1 << 19
#: A bit, in the whole numbers that costs are given in.
BIT = 1 << 16
UNKNOWN = "und"
#: Steps of an octave by which counts are ordered.
STEPS = 8
#: Distinct windows that a task holds before it hands their counts on.
HELD = 1 << 21
#: Windows that are looked up at once.
CHUNK = 1 << 18
_START = b"\n" * (WIDTH - 1)
_HELD_OUT = "pmod(crc32(cast(%s as string)), 4) = 2"


def windows(buffer: np.ndarray) -> np.ndarray:
    """The four-byte windows of a byte array, big-endian."""
    b = buffer.astype(np.uint32)
    return b[:-3] << np.uint32(24) | b[1:-2] << np.uint32(16) | b[2:-1] << np.uint32(8) | b[3:]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array, each after three line feeds, and the place of each text's first window."""
    sizes = np.array([len(t) + WIDTH - 1 for t in texts], np.int64)
    return np.frombuffer(b"".join(_START + t for t in texts), np.uint8), np.cumsum(sizes) - sizes


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def window_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: partial counts of each task over ``docs`` (lang, text)."""

    def run(batches):
        import pyarrow as pa

        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows():
            for lang, (keys, counts) in held.items():
                for at in range(0, len(keys), CHUNK):
                    k, c = keys[at : at + CHUNK], counts[at : at + CHUNK]
                    arrays = [pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(c)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "gram", "n"])

        def learn(lang: str, texts: list[bytes]) -> None:
            buffer, _ = joined(texts)
            ends = np.cumsum([len(t) + WIDTH - 1 for t in texts])
            new = [held.get(lang, (np.zeros(0, np.uint32), np.zeros(0, np.int64)))]
            for at in range(0, len(buffer) - WIDTH + 1, CHUNK * 4):
                w = windows(buffer[at : at + CHUNK * 4 + WIDTH - 1])
                # windows that end in the line feeds before the next text are none of a text's
                pads = (ends[:-1, None] + np.arange(WIDTH - 1) - WIDTH + 1).ravel() - at
                own = np.ones(len(w), bool)
                own[pads[(pads >= 0) & (pads < len(w))]] = False
                new.append(np.unique(w[own], return_counts=True))
            held[lang] = _added([k for k, _ in new], [c.astype(np.int64) for _, c in new])

        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                learn(lang, own)
            if sum(len(k) for k, _ in held.values()) > HELD:
                yield from rows()
                held = {}
        yield from rows()

    return docs.mapInArrow(run, "lang string, gram bigint, n bigint")


class Trees:
    """The languages' context trees as sorted arrays of costs: one level for each number of bytes."""

    def __init__(self, languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.languages = languages
        self.levels: list[tuple[np.ndarray, ...]] = []
        for width in range(1, WIDTH + 1):
            part = gram & np.uint32(self._mask(width))
            keys, at = np.unique(part, return_inverse=True)
            count = np.zeros((len(keys), len(languages)), np.int64)
            np.add.at(count, (at, lang), n)
            context, up = np.unique(keys >> np.uint32(8), return_inverse=True)
            total = np.zeros((len(context), len(languages)), np.int64)
            kinds = np.zeros_like(total)
            np.add.at(total, up, count)
            np.add.at(kinds, up, count > 0)
            whole = total + kinds
            escape = self._bits(whole, kinds)
            known = self._bits(whole[up], count)
            back = escape[up] + self._cost(width - 1, keys & np.uint32(self._mask(width - 1)))
            self.levels.append((keys, np.where(count > 0, known, back), context, escape))

    @staticmethod
    def _mask(width: int) -> int:
        return (1 << (8 * width)) - 1

    @staticmethod
    def _bits(whole: np.ndarray, part: np.ndarray) -> np.ndarray:
        """-log2(part / whole) in units; 0 where there is no part."""
        return np.where(part > 0, np.rint(BIT * np.log2(np.maximum(whole, 1) / np.maximum(part, 1))), 0).astype(np.int64)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def _cost(self, width: int, grams: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each gram of ``width`` bytes, one column a language."""
        if width == 0:
            return np.full((len(grams), len(self.languages)), 8 * BIT, np.int64)
        keys, cost, context, escape = self.levels[width - 1]
        at, hit = self._find(keys, grams)
        out = cost[at] if len(keys) else np.zeros((len(grams), len(self.languages)), np.int64)
        if not hit.all():
            rest = grams[~hit]
            up, known = self._find(context, rest >> np.uint32(8))
            paid = np.where(known[:, None], escape[up], 0) if len(context) else 0
            out[~hit] = paid + self._cost(width - 1, rest & np.uint32(self._mask(width - 1)))
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language, in 2**-16 bit."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        rows = np.array([i for i, t in enumerate(texts) if t], np.int64)
        if not len(rows):
            return out
        buffer, first = joined([texts[i] for i in rows])
        sizes = np.array([len(texts[i]) for i in rows])
        # each text's windows, then those of the line feeds before the next text
        bounds = np.stack([first, first + sizes], axis=1).ravel()
        for at in range(0, int(bounds[-1]), CHUNK):
            stop = min(at + CHUNK, int(bounds[-1]))
            cost = self._cost(WIDTH, windows(buffer[at : stop + WIDTH - 1]))
            begin = np.searchsorted(bounds, at, side="right") - 1
            end = np.searchsorted(bounds, stop, side="left")
            cuts = np.maximum(bounds[begin:end], at) - at
            sums = np.add.reduceat(cost, cuts, axis=0)
            part = np.arange(begin, end)
            text = part % 2 == 0
            out[rows[part[text] // 2]] += sums[text]
        return out

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and its share of the probability, all languages being equally likely before."""
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0)
        lengths = self.code_lengths(texts)
        best = lengths.argmin(axis=1)
        more = (lengths - lengths.min(axis=1)[:, None]) / BIT
        return best, 1 / np.exp2(-more).sum(axis=1)


def _level(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double")) * STEPS).cast("int")


def bounded(counts: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """The most frequent windows of each language (lang, gram, n): about ``max_nodes`` in all."""
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in counts.groupBy("lang", _level(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("c")).collect():
        sizes.setdefault(r["lang"], []).append((r["level"], r["c"]))
    room = max_nodes // max(1, len(sizes))
    cuts = []
    for lang, levels in sizes.items():
        left, cut, share = room, -1, 0
        for level, c in sorted(levels, reverse=True):
            if c > left:
                cut, share = level, left * 1000 // c
                break
            left -= c
        cuts.append((lang, cut, share))
    if not cuts:
        return counts.select("lang", "gram", "n")
    # one row a language
    cut = counts.sparkSession.createDataFrame(cuts, "cut_lang string, cut int, share int")
    level, last = _level(F.col("n")), F.pmod(F.xxhash64("gram"), F.lit(1000)) < F.col("share")
    met = counts.join(F.broadcast(cut), F.col("lang") == F.col("cut_lang"))
    return met.filter((level > F.col("cut")) | ((level == F.col("cut")) & last)).select("lang", "gram", "n")


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_nodes: int = MAX_NODES) -> Trees:
    """The trees of every language of ``docs``; rows without a language or text teach nothing."""
    text_batches(docs.sparkSession)
    ship_package(docs.sparkSession)
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")).dropna()
    counts = saved(window_counts(rows).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "windows")
    table = bounded(counts, max_nodes).toArrow()  # about max_nodes rows
    names = sorted(set(table.column("lang").to_pylist()), key=str.encode)
    number = {name: i for i, name in enumerate(names)}
    lang = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
    return Trees(names, lang, table.column("gram").to_numpy().astype(np.uint32), table.column("n").to_numpy())


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every text, whatever else the table holds."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by MAX_NODES

    def run(texts):
        best, score = model.value.predict([t.encode("utf-8", "surrogatepass") for t in texts])
        return None, {"best": [model.value.languages[i] for i in best], "score": score}

    letter = F.coalesce(docs[text_col].cast("string").rlike(r"\p{L}"), F.lit(False))
    if not trees.languages:
        return docs.select(docs[id_col].alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    whole = docs.select(F.struct(docs[id_col].alias("id"), letter.alias("letter")).alias("doc_id"), docs[text_col].alias("text"))
    found = map_texts(whole, run, "best string, score double")
    return found.select(
        F.col("doc_id.id").alias("doc_id"),
        F.when(F.col("doc_id.letter"), F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("doc_id.letter"), F.col("score")).otherwise(0.0).alias("score"),
    )


def held_out_predictions(
    docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", max_nodes: int = MAX_NODES
) -> DataFrame:
    """doc_id, held_out, lang_pred, score: trained on the rows whose remainder is not 2, applied to all."""
    rows = docs.select(*[docs[c].alias(a) for c, a in ((id_col, "doc_id"), (lang_col, "lang"), (text_col, "text"))])
    out = F.expr(_HELD_OUT % "doc_id")
    trees = train(rows.filter(~out), max_nodes=max_nodes)
    return identify(rows.select("doc_id", "text"), trees).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
