"""Removal of repeated 200-byte strings by a sparse suffix array.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else
goes. Sorting a suffix per byte would multiply the corpus by the window, so
the suffixes are a sample chosen by content: the anchor of a window is the
place in it whose ``LEAD`` leading bytes have the lowest upper half of a
64-bit hash (leftmost of equals). That depends on the window's bytes alone, so
equal windows have their anchors at the same place, and only windows whose
anchors' suffixes begin alike need comparing. About every 85th byte is an
anchor; it stands for the run of windows that chose it.

1. A first pass counts the hashes of the leading bytes in a bit filter of
   bounded size; anchors whose leading bytes occur once in the corpus are done.
2. The remaining suffixes, with the bytes of their windows, are range
   partitioned by their leading bytes with sampled splitters. A splitter is a
   leading string, so suffixes that begin alike never straddle a boundary.
3. Each bucket sorts the windows by multikey quicksort, eight bytes a level:
   windows that differ from all others leave, tied ones go on to the next
   eight bytes; those tied on all bytes are repeated. The comparison is exact.
4. Leading strings with more than ``HOT`` suffixes (a passage that a third of
   all documents share) are not sorted in one bucket: their windows are
   counted by hash with partial aggregation, at any size.

Equal suffix records travel once per batch, and a run of one character, whose
every byte is an anchor with the same record, is noted as one range of starts:
copies and runs do not multiply.

Defined cases: null and empty texts have nothing to remove; a text under 200
bytes stays whole. Repeated rows are copies of each other and go entirely
(from 200 bytes on). Matches never cross documents. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import POWERS, ranges
from .common import bit_words, flag_bits, id_text, map_texts, saved, ship_package, twice_bitmap
from .shingles import mix

WINDOW = 200
LEAD = 32
#: Suffixes with the same leading bytes that one bucket may sort.
HOT = 1 << 16
#: Bits of the filter of leading bytes: 32 MB at most.
MAX_BITS = 1 << 28
#: Suffix records that a bucket sorts at once (cut between leading strings).
SORTED_AT_ONCE = 16_384


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: prefix and suffix minima of blocks."""
    n = len(v) - width + 1
    blocks = -(-len(v) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1), np.uint64)
    padded[: len(v)] = v
    grid = padded.reshape(blocks, width)
    prefix = np.minimum.accumulate(grid, axis=1).ravel()
    suffix = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])


def anchors(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Joined bytes; per anchor its text, place, first and last window, and the hash of its leading bytes.

    Places are in the joined bytes.
    """
    data = np.frombuffer(b"".join(blobs), np.uint8)
    sizes = np.array([len(b) for b in blobs], np.int64)
    ends = np.cumsum(sizes)
    none = np.zeros(0, np.int64)
    if sizes.max(initial=0) < WINDOW:
        return data, ends, none, none, none, none, np.zeros(0, np.uint64)
    up, down = POWERS.to(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    h = mix((total[LEAD:] - total[:-LEAD]) * down[: len(data) - LEAD + 1])
    # the same half of the hash in every batch: which place is lowest must not depend on what else is in it
    shift = np.uint64(32)
    marked = ((h >> shift) << shift) | np.arange(len(h), dtype=np.uint64)
    least = _sliding_min(marked, WINDOW - LEAD + 1)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    starts = ranges((ends - sizes)[windows > 0], windows[windows > 0])
    owner = np.repeat(np.arange(len(blobs)), windows)
    place = (least[starts] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    at = place[first]
    return data, ends, owner[first], at, starts[first], starts[last], h[at]


def _record_key(left: int, record: bytes) -> bytes:
    return hashlib.blake2b(record, digest_size=16, salt=left.to_bytes(8, "little")).digest()


def repeated_windows(records: list[bytes]) -> np.ndarray:
    """Starts, in the joined records, of the windows that equal another window of any record.

    Multikey quicksort with eight-byte characters: a level orders the tied
    windows by their next eight bytes within their group.
    """
    data = np.frombuffer(b"".join(records) + b"\0" * 8, np.uint8)
    word = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        word |= data[k : k + len(word)].astype(np.uint64) << np.uint64(56 - 8 * k)
    sizes = np.array([len(r) for r in records], np.int64)
    at = ranges(np.cumsum(sizes) - sizes, sizes - WINDOW + 1)
    group = np.zeros(len(at), np.int64)
    for level in range(0, WINDOW, 8):
        key = word[at + level]
        order = np.argsort(key, kind="stable") if level == 0 else np.lexsort((key, group))
        at, key, group = at[order], key[order], group[order]
        new = np.ones(len(at) + 1, bool)
        new[1:-1] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        tied = ~(new[:-1] & new[1:])
        group = np.cumsum(new[:-1])[tied]
        at = at[tied]
        if not len(at):
            break
    return np.sort(at)


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring windows as byte ranges."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + WINDOW


def _sorted_bucket(batches):
    """Records sorted by their leading bytes in; key and repeated byte ranges of each distinct record out."""

    def solve(rows):
        distinct: dict[bytes, bytes] = {}
        again: set[bytes] = set()
        for key, record in rows:
            if key in distinct:
                again.add(key)
            distinct[key] = record
        keys, records = list(distinct), list(distinct.values())
        sizes = np.array([len(r) for r in records], np.int64)
        begins = np.cumsum(sizes) - sizes
        hit = repeated_windows(records)
        whose = np.searchsorted(begins, hit, side="right") - 1
        parts = np.split(hit - begins[whose], np.flatnonzero(np.diff(whose)) + 1) if len(hit) else []
        found = dict(zip(np.unique(whose).tolist(), parts, strict=True))
        out = {"key": [], "froms": [], "tos": []}
        for i, key in enumerate(keys):
            if key in again:
                a, b = np.array([0]), np.array([sizes[i]])
            elif i in found:
                a, b = _runs(found[i])
            else:
                continue
            out["key"].append(key)
            out["froms"].append(a)
            out["tos"].append(b)
        types = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=t) for v, t in zip(out.values(), types, strict=True)], names=list(out)
        )

    waiting: list[tuple[bytes, bytes]] = []
    lead, whole = None, 0  # rows of ``waiting`` before ``whole`` belong to complete groups
    for batch in batches:
        for this, key, record in zip(*(batch.column(c).to_pylist() for c in ("lead", "key", "record")), strict=True):
            if this != lead:
                lead, whole = this, len(waiting)
                if whole >= SORTED_AT_ONCE:
                    yield solve(waiting)
                    waiting, whole = [], 0
            waiting.append((key, record))
    if waiting:
        yield solve(waiting)


def _leading_bits(docs: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Bits of the leading hashes that occur twice or more in the corpus."""

    def run(texts):
        _, _, owner, _, _, _, h = anchors([t.encode() for t in texts])
        count = np.bincount(owner, minlength=len(texts))
        return None, {"heads": np.split(h.view(np.int64), np.cumsum(count)[:-1])}

    heads = map_texts(docs, run, "heads array<bigint>", id_col, text_col).select(F.explode("heads").alias("head"))
    return twice_bitmap(heads, "head", MAX_BITS)


def _records(docs: DataFrame, bits, id_col: str, text_col: str) -> DataFrame:
    """Per text its SHA-256, the starts and keys of its suffix records, and the records new to the batch.

    ``counts`` tells at how many neighbouring starts the same record lies.
    """

    def run(texts):
        filled = bits.value
        blobs = [t.encode() for t in texts]
        data, ends, owner, at, first, last, h = anchors(blobs)
        bit = (h & np.uint64(MAX_BITS - 1)).astype(np.int64)
        take = (filled[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        owner, at, first, last = owner[take], at[take], first[take], last[take]
        raw = data.tobytes()
        begin = ends - np.array([len(b) for b in blobs], np.int64)
        out = {"sha": [hashlib.sha256(b).digest() for b in blobs]}
        for name in ("starts", "counts", "keys", "lefts", "fresh", "records"):
            out[name] = [[] for _ in blobs]
        seen: set[bytes] = set()
        rows = zip(owner.tolist(), at.tolist(), first.tolist(), last.tolist(), begin[owner].tolist(), strict=True)
        before = None
        for i, p, a, b, zero in rows:
            record = raw[a : b + WINDOW]
            if before == (i, a - 1, p - a, record):
                out["counts"][i][-1] += 1
            else:
                key = _record_key(p - a, record)
                out["starts"][i].append(a - zero)
                out["counts"][i].append(1)
                out["keys"][i].append(key)
            before = (i, a, p - a, record)
            # two occurrences in a batch are as good as any number
            again = key + b"2" if key in seen else key
            if again not in seen:
                seen.add(again)
                out["fresh"][i].append(key)
                out["lefts"][i].append(p - a)
                out["records"][i].append(record)
        return None, out

    fields = "sha binary, starts array<bigint>, counts array<bigint>, keys array<binary>, lefts array<int>, fresh array<binary>, records array<binary>"
    return map_texts(docs, run, fields, id_col, text_col)


def _hot_windows(hot: DataFrame) -> DataFrame:
    """Repeated byte ranges of records whose leading bytes are hot, by hashes of their windows."""

    def hashes(batches):
        for batch in batches:
            keys, values = [], []
            for key, record in zip(batch.column("key").to_pylist(), batch.column("record").to_pylist(), strict=True):
                keys.append(key)
                values.append(
                    [hashlib.blake2b(record[i : i + WINDOW], digest_size=16).digest() for i in range(len(record) - WINDOW + 1)]
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(values, pa.list_(pa.binary()))], names=["key", "windows"]
            )

    ship_package(hot.sparkSession)
    each = hot.select("key", "record").mapInArrow(hashes, "key binary, windows array<binary>")
    each = saved(each.select("key", F.posexplode("windows").alias("at", "w")), "hot-windows")
    twice = each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select(F.col("w").alias("v"))
    met = each.join(twice, F.col("w") == F.col("v")).groupBy("key").agg(F.collect_set("at").alias("at"))
    at = F.col("at").cast("array<bigint>")
    return met.select("key", at.alias("froms"), F.transform(at, lambda x: x + WINDOW).alias("tos"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``sha`` (SHA-256 of a text) and ``ranges`` (repeated byte ranges, unmerged) of texts that have any."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_leading_bits(docs, id_col, text_col))
    table = saved(_records(docs, bits, id_col, text_col), "suffix-records")
    fresh = table.select(F.explode(F.arrays_zip("fresh", "lefts", "records")).alias("x")).select(
        F.col("x.fresh").alias("key"),
        F.expr(f"substring(x.records, x.lefts + 1, {LEAD})").alias("lead"),
        F.col("x.records").alias("record"),
    )
    sizes = fresh.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select(F.col("lead").alias("hot"))
    sizes = saved(sizes, "hot-leads")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "key binary, froms array<bigint>, tos array<bigint>"
    cold = fresh
    found = None
    if sizes.limit(1).count():
        cold = fresh.join(sizes, F.col("lead") == F.col("hot"), "left_anti")
        found = _hot_windows(fresh.join(sizes, F.col("lead") == F.col("hot"), "left_semi"))
    ship_package(spark)
    ordered = cold.repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    solved = ordered.mapInArrow(_sorted_bucket, schema)
    found = saved(solved if found is None else solved.union(found), "repeated-windows")
    each = table.select("sha", F.explode(F.arrays_zip("starts", "counts", "keys")).alias("x"))
    each = each.select("sha", F.col("x.starts").alias("start"), F.col("x.counts").alias("count"), F.col("x.keys").alias("k")).distinct()
    met = each.join(found, F.col("k") == F.col("key"))
    # the same range from each of the neighbouring starts: together one
    span = lambda a, b: F.struct((a + F.col("start")).alias("a"), (b + F.col("start") + F.col("count") - 1).alias("b"))
    return met.select(
        "sha",
        F.explode(F.zip_with("froms", "tos", span)).alias("r"),
    ).groupBy("sha").agg(F.collect_list("r").alias("ranges"))


def merged(ranges_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of byte ranges as maximal runs."""
    out: list[list[int]] = []
    for a, b in sorted(ranges_):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed)."""
    found = saved(repeated_ranges(docs, id_col, text_col, hot), "repeated-ranges")
    rows = id_text(docs, id_col, text_col).withColumn("sha", F.unhex(F.sha2("text", 256)))
    flagged = flag_bits(rows, "sha", saved(bit_words(found, "sha"), "repeated-bits"), "maybe")
    kind = rows.schema["doc_id"].dataType.simpleString()
    met = flagged.filter("maybe").join(found.withColumnRenamed("sha", "s"), F.col("sha") == F.col("s"), "left")

    def cut(batches):
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
            for text, found_ in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                blob = text.encode()
                runs = merged([(r["a"], r["b"]) for r in found_ or ()])
                kept = hashlib.sha256()
                at = 0
                for a, b in runs:
                    kept.update(blob[at:a])
                    at = b
                kept.update(blob[at:])
                out["n_bytes"].append(len(blob))
                out["n_removed"].append(sum(b - a for a, b in runs))
                out["n_spans"].append(len(runs))
                out["kept_sha256"].append(kept.hexdigest())
                out["spans"].append([x for r in runs for x in r])
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            arrays = [pa.array(v, type=t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *out])

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"
    some = met.select("doc_id", "text", "ranges").mapInArrow(cut, schema)
    rest = flagged.filter(~F.col("maybe")).select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.lower(F.hex("sha")).alias("kept_sha256"),
        F.array().cast("array<bigint>").alias("spans"),
    )
    return some.union(rest)
