"""SimHash near-duplicates through deletion-variant signatures.

A text's fingerprint has 64 bits, each set if it is set in over half of the hashes of its 3-word
shingles. Two fingerprints at distance 3 or less differ in at most one bit in one of their two
halves. So every distinct fingerprint is indexed under its one-wildcard variants (each half with
each of its 32 bits blanked), rows sharing a variant meet by equality, and the full distance is
verified. Halves are counted first, by partial aggregation, so that a bucket that may hold more than
``BUCKET_ROWS`` fingerprints is known before anything is gathered: its members go straight to the
next cut, by the variants of the other half (two 16-bit parts), then by those of the last 16 bits
(two 8-bit parts). What shares all three variants differs in at most 11 bits, so no bucket exceeds
2,048 rows in the end and none is dropped. A bucket yields links of a spanning forest, not its pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.llm.common import free_names, row_key
from venueflow.llm.components import components
from venueflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
MAX_BITS = 3
BUCKET_ROWS = 4096  # larger buckets are cut once more; after the third cut 2,048 is the most possible
FOREST_ROWS = 1 << 20  # links a task remembers
SHINGLE_BLOCK = 1 << 16  # shingles whose bits are counted at a time


def text_fingerprint(text: str | None) -> int:
    """SimHash of one text, as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    n = len(words)
    if n == 0:
        return 0
    body = b" ".join(words)
    if n < 3:
        hashes = xxhash.xxh64_digest(body, SEED)
        count = 1
    else:
        count = n - 2
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(body[s:e], SEED) for s, e in zip(starts[:count].tolist(), ends[2:].tolist())])
    table = np.frombuffer(hashes, dtype=np.uint8).reshape(count, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, count, SHINGLE_BLOCK):
        ones += np.unpackbits(table[i : i + SHINGLE_BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """The ``keep`` columns and ``fp`` (bigint holding the 64 bits) of every row."""
    rows = docs.select(docs[text].alias("text"), F.struct(*keep).alias("keep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(text_fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("keep"), pa.array(fps, type=pa.int64())], names=["keep", "fp"])

    kind = rows.schema["keep"].dataType.simpleString()
    return rows.mapInArrow(run, f"keep {kind}, fp long").select("keep.*", "fp")


def _crowded(rows: DataFrame, width: int, most: int) -> DataFrame:
    """(key, part, value, full, send) of the halves that meet in buckets of possibly more than ``most`` rows.

    A bucket is a half's value and the one that differs in the blanked bit, so it can only be that
    large if one of the two is held by more than ``most / 2`` rows (``full``). ``send`` has the bits
    under which a half goes to the next cut: those with a neighbour where one of the two is full, and
    for a full half the first, where its own members meet.
    """
    half = width // 2
    low = F.lit((1 << half) - 1).cast("long")
    parts = rows.select("key", "fp", "off", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    parts = parts.select("key", "part", F.col("off").alias("o"), "fp").withColumn("shift", (F.col("o") + F.col("part") * half).cast("int"))
    value = F.expr("shiftrightunsigned(fp, shift)").bitwiseAND(low)
    counts = materialize(parts.select("key", "part", value.alias("value")).groupBy("key", "part", "value").agg(F.count("*").alias("n")), "simhash-halves")
    full = counts.filter(F.col("n") > most // 2).select("key", "part", "value")
    by_bit = full.select("*", F.explode(F.sequence(F.lit(0), F.lit(half - 1))).alias("bit"))
    by_bit = by_bit.withColumn("mask", F.expr("shiftleft(1L, bit)")).withColumn("near", F.col("value").bitwiseXOR(F.col("mask")))
    there = counts.select("key", "part", F.col("value").alias("near"))
    mixed = by_bit.join(there, ["key", "part", "near"])
    own = full.select("key", "part", "value", F.lit(True).alias("full"), F.lit(1).cast("long").alias("send"))
    out = own.union(mixed.select("key", "part", "value", F.lit(True), "mask")).union(mixed.select("key", "part", "near", F.lit(False), "mask"))
    return out.groupBy("key", "part", "value").agg(F.max("full").alias("full"), F.bit_or("send").alias("send"))


def _variants(rows: DataFrame, width: int, crowded: DataFrame | None = None) -> DataFrame:
    """One row for each one-wildcard variant of either half of the ``width`` bits still in play.

    ``rows`` has (key, fp, off): the bits in play are [off, off + width). The variant's key covers
    the earlier key, the wildcard's place and the half without that bit; the other half stays in play.
    ``send`` says that the variant's bucket is crowded: it is cut again instead of gathered.
    """
    half = width // 2
    part = F.explode(F.array(F.lit(0), F.lit(1)))
    df = rows.select("key", "fp", F.col("off").cast("int").alias("off"), part.alias("part"))
    df = df.withColumn("start", (F.col("off") + F.col("part") * half).cast("int"))
    df = df.withColumn("value", F.expr("shiftrightunsigned(fp, start)").bitwiseAND(F.lit((1 << half) - 1).cast("long")))
    if crowded is not None:
        df = df.join(crowded, ["key", "part", "value"], "left")
    else:
        df = df.withColumns({"full": F.lit(False), "send": F.lit(0).cast("long")})
    df = df.withColumns({"full": F.coalesce("full", F.lit(False)), "sent": F.coalesce("send", F.lit(0).cast("long"))})
    df = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(half - 1))).alias("place"))
    one = F.expr("shiftright(value, place) & 1L") == 1
    send = F.expr("shiftright(sent, place) & 1L") == 1
    rest = F.expr("value & ~shiftleft(1L, place)")
    other = (2 * F.col("off") + half - F.col("start")).cast("int")
    df = df.filter(~F.col("full") | send)  # a full half's own members meet once, under the first bit
    return df.select(
        F.xxhash64("key", F.lit(width), "part", "place", rest).alias("key"), "fp", other.alias("off"),
        (F.col("place") == 0).alias("first"), one.alias("one"), send.alias("send"),
    )


class _Forest:
    """Union-find over the links one task has found, so that it passes each on once."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _near(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints (uint64) within MAX_BITS of each other."""
    left = np.arange(len(fps))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            close = np.bitwise_count(fps[left] ^ fps[here]) <= MAX_BITS
            for x in left[close]:
                yield here, x
                queue.append(x)
            left = left[~close]


def _bucket_links(rows: DataFrame) -> DataFrame:
    """(a, b): links of the fingerprints that share a bucket ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, tail = _Forest(), None

        def solve(key, fp, first, one):
            if len(forest.up) > FOREST_ROWS:
                forest.up.clear()  # links may then be told again, which does no harm
            a, b = [], []
            edge = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts = np.concatenate(([0], edge))
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            many = sizes > 1
            # Members equal in their half meet under every wildcard: they are compared at the first only.
            ones = np.add.reduceat(one.astype(np.int64), starts)
            many &= first[starts] | ((ones > 0) & (ones < sizes))
            for s, n in zip(starts[many].tolist(), sizes[many].tolist()):
                group = fp[s : s + n]
                for i, j in _near(group.view(np.uint64)):
                    x, y = int(group[i]), int(group[j])
                    if forest.join(x, y):
                        a.append(x), b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "first", "one")]
            if tail is not None:
                now = [np.concatenate(x) for x in zip(tail, now)]
            last = int(np.searchsorted(now[0], now[0][-1], side="left")) if len(now[0]) else 0
            if last:
                yield from solve(*[x[:last] for x in now])
            tail = [x[last:] for x in now]
        if tail is not None and len(tail[0]):
            yield from solve(*tail)

    dealt = rows.select("key", "fp", "first", "one").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct(fp)`` lying within MAX_BITS of each other."""
    found, width = [], 64
    rows = distinct.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("off"))
    while True:
        # After the last cut a bucket is bounded by its 11 free bits and is gathered whatever its size.
        crowded = materialize(_crowded(rows, width, BUCKET_ROWS), f"simhash-crowded-{width}") if width > 16 else None
        variants = _variants(rows, width, crowded)
        found.append(materialize(_bucket_links(variants.filter(~F.col("send"))), f"simhash-links-{width}"))
        if crowded is None or crowded.isEmpty():
            break
        rows, width = materialize(variants.filter("send").select("key", "fp", "off"), f"simhash-cut-{width}"), width // 2
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def group_fingerprints(rows: DataFrame) -> DataFrame:
    """(fp, root) for the fingerprints of ``rows(fp)`` that link to another one."""
    return components(near_links(rows.select("fp").distinct()), "simhash-components")


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    component_id is the smallest id whose text is reachable over links. Null and empty texts have
    fingerprint zero and link like any other; rows with a null id get a component but never name
    one (null if it has no other); repeated rows share a component; an empty table gives an empty one.
    """
    rows = materialize(fingerprints(docs, text, [docs[doc_id].alias("doc_id")]), "simhash-rows")
    per_fp = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = group_fingerprints(per_fp)
    rooted = per_fp.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Only the linked fingerprints change their name; the others keep the smallest id of their own rows.
    by_fp = materialize(
        per_fp.join(rooted.join(named, "root").select("fp", "component_id"), "fp", "left")
        .select("fp", F.coalesce("component_id", "least").alias("component_id")),
        "simhash-names",
    )
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of linked texts: the one with the smallest id (nulls last).

    Rows that share id and group are told apart by a hash of all columns; of wholly equal rows one stays.
    """
    key, order = free_names(docs, "row_key", "order_key")
    whole = row_key(docs)
    rows = materialize(fingerprints(docs, text, [docs[doc_id].alias("doc_id"), whole.alias("row_key")]), "simhash-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")).alias("least")
    per_fp = materialize(rows.groupBy("fp").agg(least), "simhash-distinct")
    roots = group_fingerprints(per_fp)
    groups = per_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(F.coalesce("root", "fp").alias("root"), "least")
    kept = groups.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias(order), F.col("least.row_key").alias(key)
    )
    keyed = docs.withColumn(key, whole)
    match = (keyed[key] == kept[key]) & keyed[doc_id].eqNullSafe(kept[order])
    return keyed.join(kept.select(key, order).distinct(), match, "left_semi").dropDuplicates([key, doc_id]).drop(key)
