"""Periodic runs of words: stretches in which a phrase is said at least ``MIN_TIMES`` times in a row.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at least
max(MIN_WORDS, MIN_TIMES * q) words. Periods are handled by octave, [P, 2 P) with P a power of two.

* ``cut`` explodes every document into overlapping tiles, whose width grows with the octave (the
  octaves below ``SMALL`` share their tiles).
* ``solve`` treats tiles independently. Boundaries stand at every multiple of P. At a boundary b and
  for a period q, words [b, b + P) must return q later; one comparison of block hashes per word finds
  all such (b, q). Periods whose block is itself repeated are not smallest and go. Around the rest
  the Z-values of the words right and left of the boundary are taken exactly, up to 2 P and P words.
  A run matches over 3 P words at least, so it contains a whole block, and its pieces touch.
* Pieces that cannot be part of a run are dropped where tile and document allow to see it. The others
  are shuffled by document and period and stitched to runs.

Texts of up to ``LONG_CHARS`` characters are cut and solved where they are read; the tiles of longer
ones are dealt out over the cluster. Only texts with pieces are carried to the last step.

Defined results: null and empty texts have no words and no runs; a document of any length is solved
whole; equal rows get equal results; rows sharing an id, or without one, are handled on their own;
columns other than id and text are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueflow.llm.common import words
from venueflow.llm.quality import let
from venueflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_TIMES = 4
MIN_WORDS = 6
SMALL = 9  # octaves below this one share tiles: periods under 512
CORE = 2048  # words between the starts of these tiles; a larger octave's tiles start 8 P apart
LONG_CHARS = 1 << 20
SLICE_CHARS = 1 << 22  # text handled at a time, whole texts only
CELLS = 1 << 22  # comparisons around boundaries at a time
TILES_A_ROW = 16
BASE = 0x9E3779B97F4A7C15  # odd; block hashes are polynomials in it modulo 2^64

TILE = "struct<first:int,last:int,start:bigint,opens:boolean,closes:boolean,codes:array<int>>"
RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"
PIECE = "struct<period:bigint,lo:bigint,hi:bigint>"
TILE_TYPE = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("opens", pa.bool_()), ("closes", pa.bool_()), ("codes", pa.list_(pa.int32()))])


def tiles_of(codes: np.ndarray, core: int = CORE, small: int = SMALL) -> Iterator[tuple[int, int, int, bool, bool, np.ndarray]]:
    """(first octave, last octave, start, whether it begins the document, whether it ends it, codes) of every tile.

    Neighbours overlap by 4 P words: a match of words q < 2 P apart that crosses an end is seen over 2 P words on both sides.
    """
    n = len(codes)
    first, last, step = 0, small - 1, core
    while n >= MIN_TIMES << first:
        width = step + (4 << last)
        start = 0
        while True:
            yield first, last, start, start == 0, start + width >= n, codes[start : start + width]
            if start + width >= n:
                break
            start += step
        first = last = last + 1
        step = 8 << first


def primes_of(q: int) -> tuple[int, ...]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return (*out, q) if q > 1 else tuple(out)


def _mixed(codes: np.ndarray) -> np.ndarray:
    v = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(32))


class Flat:
    """Tiles side by side, longest first, a word of its own between them; with what hashing needs."""

    def __init__(self, tiles: list[np.ndarray], pad: int) -> None:
        sizes = np.array([len(t) for t in tiles], dtype=np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.start = pad + np.cumsum(self.sizes + 1) - self.sizes - 1
        self.end = self.start + self.sizes
        total = int(self.end[-1]) + 1
        self.words = np.arange(-1, -1 - total - 4 * pad, -1, dtype=np.int64)  # every place outside the tiles differs from all others
        for k, at, end in zip(self.order.tolist(), self.start.tolist(), self.end.tolist()):
            self.words[at:end] = tiles[k]
        self.total = total

    def used(self, least: int) -> int:
        """Places up to the end of the last tile of at least so many words."""
        k = int(np.searchsorted(-self.sizes, -least, side="right"))
        return int(self.end[k - 1]) + 1 if k else 0


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def pieces_of(tiles: list[np.ndarray], first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, lo, hi): longest stretches [lo, hi) of places equal to those ``period`` later, inside each tile."""
    flat = Flat(tiles, 2 << last)
    value = _mixed(flat.words)
    power = _powers(len(value) + 1)
    upto = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(value * power[:-1], dtype=np.uint64)))  # word i weighs BASE^i
    found = []
    block = value
    for k in range(last + 1):
        p = 1 << k
        if k:
            half = p >> 1
            block = block[:-half] * np.uint64(pow(BASE, half, 1 << 64)) + block[half:]
        if k < first or not (used := flat.used(MIN_TIMES * p)):
            continue
        own = block[:used]
        at = np.flatnonzero(own[p:] == np.repeat(own[::p], p)[: len(own) - p]) + p
        bound = (at // p - 1) * p
        q = at - bound
        tile = np.searchsorted(flat.start, bound, side="right") - 1
        inside = (tile >= 0) & (at + p <= flat.end[tile])  # a period may reach over the word between two tiles
        bound, q = bound[inside], q[inside]
        smallest = np.ones(len(q), dtype=bool)
        by_period = np.argsort(q, kind="stable")
        periods, begin = np.unique(q[by_period], return_index=True)
        for period, same in zip(periods.tolist(), np.split(by_period, begin[1:])):
            b = bound[same]
            for r in primes_of(period):
                d = period // r
                smallest[same] &= (upto[b + period - d] - upto[b]) * power[d] != upto[b + period] - upto[b + d]
        bound, q = bound[smallest], q[smallest]
        step = max(1, CELLS // (3 * p))
        for i in range(0, len(q), step):
            b, gap = bound[i : i + step], q[i : i + step]
            place = b[:, None] + np.arange(-p, 2 * p)
            equal = flat.words[place] == flat.words[place + gap[:, None]]
            left = np.where(equal[:, :p].all(axis=1), p, np.argmin(equal[:, p - 1 :: -1], axis=1))
            right = np.where(equal[:, p:].all(axis=1), 2 * p, np.argmin(equal[:, p:], axis=1))
            whole = right >= p
            b, gap, left, right = b[whole], gap[whole], left[whole], right[whole]
            tile = np.searchsorted(flat.start, b, side="right") - 1
            found.append((gap, np.maximum(b - left, flat.start[tile]), np.minimum(b + right, flat.end[tile] - gap)))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 4
    q, lo, hi = (np.concatenate(x) for x in zip(*found))
    q, lo, hi = stitch(q, lo, hi)
    own = np.searchsorted(flat.start, lo, side="right") - 1
    return flat.order[own], q, lo - flat.start[own], hi - flat.start[own]


def stitch(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals of each period that overlap or touch."""
    if not len(q):
        return q, lo, hi
    order = np.lexsort((lo, q))
    q, lo, hi = q[order], lo[order], hi[order]
    apart = np.cumsum(np.concatenate(([0], (np.diff(q) > 0).astype(np.int64)))) * (int(hi.max()) + 2)  # periods one after the other
    reach = np.maximum.accumulate(hi + apart)
    new = np.flatnonzero(np.concatenate(([True], (lo + apart)[1:] > reach[:-1])))
    return q[new], lo[new], np.maximum.reduceat(hi, new)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _tile_array(rows: list[list[tuple]]) -> pa.Array:
    flat = [t for r in rows for t in r]
    first, last, start, opens, closes, codes = zip(*flat) if flat else ([],) * 6
    ends = np.cumsum([0, *map(len, codes)]).astype(np.int32)
    body = np.concatenate([*codes]).astype(np.int32) if flat else np.zeros(0, dtype=np.int32)
    fields = [pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(start, pa.int64()), pa.array(opens, pa.bool_()), pa.array(closes, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends), pa.array(body))]
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]).astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(TILE_TYPE)))


def _cut(docs: DataFrame, apart: bool, core: int, small: int) -> DataFrame:
    """Rows with a document's words and its tiles; ``apart`` gives tiles rows of their own, to be dealt out."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for i, j in _slices([len(t) for t in texts]):
                number: dict[bytes, int] = {}
                at, said, plain, tiles, carry = [], [], [], [], []
                for k in range(i, j):
                    own = texts[k].split()  # bytes are cut at just the blanks that separate words
                    codes = np.fromiter((number.setdefault(w, len(number)) for w in own), dtype=np.int32, count=len(own))
                    joined = b" ".join(own)
                    mine = list(tiles_of(codes, core, small))
                    at.append(k)
                    said.append(joined)
                    plain.append(hashlib.sha256(joined).hexdigest())
                    tiles.append([] if apart else mine)
                    carry.append(apart)
                    for x in range(0, len(mine) if apart else 0, TILES_A_ROW):
                        at.append(k)
                        said.append(None)
                        plain.append(None)
                        tiles.append(mine[x : x + TILES_A_ROW])
                        carry.append(False)
                ids = [batch.column(c).take(pa.array(at)) for c in ("doc_id", "t1", "t2")]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(said, pa.binary()).cast(pa.string()), pa.array(plain, pa.string()), pa.array(carry), _tile_array(tiles)], names=["doc_id", "t1", "t2", "words", "plain", "carry", "tiles"])

    return docs.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, words string, plain string, carry boolean, tiles array<{TILE}>")


def _solve(cut: DataFrame) -> DataFrame:
    """The pieces of every row's tiles; the words only where there are pieces, or tiles elsewhere."""
    kind = cut.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("tiles")
            owner = np.repeat(np.arange(len(batch)), np.diff(column.offsets.to_numpy()))
            flat = column.flatten()
            codes = flat.field("codes")
            body, ends = codes.flatten().to_numpy(), codes.offsets.to_numpy() - codes.offsets[0].as_py()
            first, last, start = (flat.field(c).to_numpy() for c in ("first", "last", "start"))
            opens, closes = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("opens", "closes"))
            got = []
            for k in np.unique(first).tolist():
                here = np.flatnonzero(first == k)
                tiles = [body[ends[x] : ends[x + 1]] for x in here.tolist()]
                for i, j in _slices([8 * len(t) for t in tiles]):
                    tile, q, lo, hi = pieces_of(tiles[i:j], k, int(last[here[0]]))
                    x = here[i:j][tile]
                    inside = ((lo > 0) | opens[x]) & ((hi + q < np.diff(ends)[x]) | closes[x])
                    kept = ~inside | (hi - lo >= np.maximum((MIN_TIMES - 1) * q, MIN_WORDS - q))
                    got.append(np.stack((owner[x], q, lo + start[x], hi + start[x]), axis=1)[kept])
            rows = np.concatenate(got) if got else np.zeros((0, 4), dtype=np.int64)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            count = np.bincount(rows[:, 0], minlength=len(batch))
            pieces = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], names=["period", "lo", "hi"])
            pieces = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pieces)
            carried = pc.if_else(pc.or_(batch.column("carry"), pa.array(count > 0)), batch.column("words"), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "t1", "t2")], carried, batch.column("plain"), pieces], names=["doc_id", "t1", "t2", "words", "plain", "pieces"])

    return cut.mapInArrow(run, f"doc_id {kind}, t1 long, t2 long, words string, plain string, pieces array<{PIECE}>")


def _finish(rows: DataFrame) -> DataFrame:
    """Digests of the runs and of the words that stay; the latter's text where a word goes."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, texts, digests = [], [], []
            for said, plain, found in zip(*(batch.column(c).to_pylist() for c in ("words", "plain", "runs"))):
                found = found or []
                text = None
                if found:
                    own = said.split(" ")
                    step = np.zeros(len(own) + 1, dtype=np.int64)
                    for r in found:
                        step[r["start"] + r["period"]] += 1
                        step[r["start"] + r["length"]] -= 1
                    text = " ".join([own[x] for x in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])
                lines = "".join([f"{r['start']},{r['length']},{r['period']}\n" for r in found])
                shas.append(hashlib.sha256(lines.encode()).hexdigest())
                texts.append(text)
                digests.append(plain if text is None else hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("runs"), pa.array(shas, pa.string()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                names=["doc_id", "runs", "runs_sha256", "collapsed", "collapsed_sha256"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, runs {RUNS}, runs_sha256 string, collapsed string, collapsed_sha256 string")


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs from ``pieces(doc_id, t1, t2, period, lo, hi)``: (doc_id, t1, t2, start, length, period)."""
    by = ["doc_id", "t1", "t2", "period"]
    along = Window.partitionBy(*by).orderBy("lo", "hi")
    reach = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.distinct()  # equal rows of the documents have equal pieces
    pieces = pieces.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    pieces = pieces.withColumn("island", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = pieces.groupBy(*by, "island").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length"))
    whole = F.col("length") >= F.greatest(F.lit(MIN_WORDS), MIN_TIMES * F.col("period"))
    return joined.filter(whole).select("doc_id", "t1", "t2", "start", "length", "period")


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", long_chars: int = LONG_CHARS, core: int = CORE, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, runs (by start, then period), runs_sha256, collapsed, collapsed_sha256.

    ``collapsed`` is the text without the words that a run says again, joined by one blank, and null
    where none goes; its digest is always there. The runs' digest is of lines ``start,length,period``.
    """
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2"), body.alias("text"))
    short = _cut(rows.filter(F.length("text") <= long_chars), False, core, small)
    long = _cut(rows.filter(F.length("text") > long_chars), True, core, small).repartition("doc_id", "t1", "t2", F.xxhash64("tiles"))
    solved = materialize(_solve(short.union(long)), "period-pieces")
    pieces = solved.select("doc_id", "t1", "t2", F.explode("pieces").alias("piece")).select("doc_id", "t1", "t2", "piece.*")
    runs = stitched(pieces).groupBy("doc_id", "t1", "t2").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = runs.select(F.col("doc_id").alias("run_doc"), F.col("t1").alias("run_t1"), F.col("t2").alias("run_t2"), "runs")
    here = solved.filter(F.col("plain").isNotNull()).select("doc_id", "t1", "t2", "words", "plain")
    same = here["doc_id"].eqNullSafe(runs["run_doc"]) & (here["t1"] == runs["run_t1"]) & (here["t2"] == runs["run_t2"])
    joined = here.join(runs, same, "left").select("doc_id", "words", "plain", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    return _finish(joined)


def with_loops(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the texts, chosen by the crc32 of the decimal id, say a phrase of their own again
    and again from some word on. Without an id or words a text stays as it is."""
    h = F.crc32(docs[doc_id].cast("string"))
    g = F.floor(h / 10)

    def looped(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.concat(F.slice(w, 1, a), F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))), " ")

    own = F.when(F.size(words(docs[text])) > 0, let(words(docs[text]), looped))
    return docs.select(docs[doc_id].alias("doc_id"), F.when(h % 10 == 0, F.coalesce(own, docs[text])).otherwise(docs[text]).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """What is told of each document's runs: their number, the longest one, and the digests."""
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"], r["length"]))), 1)
    best = F.when(F.size("runs") > 0, best)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best")["length"] * 1000 / F.col("best")["period"]).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
