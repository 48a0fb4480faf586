"""Packing documents into rows of fixed length: best fit, decreasing, written as binary matrices.

Texts become token ids. A document longer than a row is split into whole rows and a remainder, in
order and without loss. Remainders are packed by best fit in decreasing length: a segment tree over
free capacities finds the fullest row that still has room. Each task packs windows of
``WINDOW_TOKENS``, so nothing grows with the table.

A window becomes one shard in the shared folder: ``.ids`` (16-bit matrix, rows of ``row_tokens``,
padded with END), ``.cu`` (32-bit cumulative segment lengths, each row's starting with 0), ``.at``
(64-bit, where each row's lengths begin in ``.cu``), and ``.reset`` (for every segment its row, the
place where positions start anew, and the token of its document that stands there).

Defined results: null and empty texts are one END; a text of any length is split losslessly;
repeated rows and null ids are packed on their own; an empty table writes no shard.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.llm import tokenfiles
from venueflow.llm.tokenfiles import END, RANKS, WordCodes, open_folder, read_ranks, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(tokenfiles)

ROW_TOKENS = 2048
WINDOW_TOKENS = 4 << 20


class Capacities:
    """Segment tree over free room 0..n: counts of rows, and the least room of at least a given size."""

    def __init__(self, n: int) -> None:
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, room: int) -> int:
        """The smallest room >= ``room`` that a row has, or -1."""
        i, count = self.leaves + room, self.count
        while not count[i]:
            while i & 1:  # right children: nothing larger under this parent
                i >>= 1
            if not i:
                return -1
            i += 1
        while i < self.leaves:
            i = 2 * i if count[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit(lengths: list[int], room: int) -> list[int]:
    """Row of every piece; pieces are placed in decreasing length, each into the fullest row that holds it."""
    tree, by_room, rows, out = Capacities(room), {}, 0, [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free = tree.least(lengths[i])
        if free < 0:
            row, free, rows = rows, room, rows + 1
        else:
            row = by_room[free].pop()
            tree.add(free, -1)
        out[i], left = row, free - lengths[i]
        by_room.setdefault(left, []).append(row)
        tree.add(left, 1)
    return out


def pack_window(ids: np.ndarray, ends: np.ndarray, row_tokens: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The shard's arrays, and per segment (document, part, row, start in row, length, token of its document)."""
    pieces = []  # (length, document, part, from)
    begin = 0
    for d, end in enumerate(ends.tolist()):
        for part, at in enumerate(range(begin, end, row_tokens)):
            pieces.append((min(row_tokens, end - at), d, part, at))
        begin = end
    rows = best_fit([p[0] for p in pieces], row_tokens)
    n = max(rows) + 1
    matrix, used = np.full((n, row_tokens), END, dtype="<u2"), [0] * n
    cuts: list[list[int]] = [[0] for _ in range(n)]
    starts = np.concatenate(([0], ends[:-1]))
    segments = np.zeros((len(pieces), 6), dtype=np.int64)
    for i, ((length, d, part, at), r) in enumerate(zip(pieces, rows)):
        matrix[r, used[r] : used[r] + length] = ids[at : at + length]
        segments[i] = d, part, r, used[r], length, at - starts[d]
        used[r] += length
        cuts[r].append(used[r])
    sizes = np.array([len(c) for c in cuts], dtype=np.int64)
    shard = {"ids": matrix, "cu": np.concatenate([np.array(c, dtype="<i4") for c in cuts]), "at": (np.cumsum(sizes) - sizes).astype("<i8"), "reset": segments[:, [2, 3, 5]].astype("<i8")}
    return shard, segments


SEGMENTS = "doc_id {}, part int, shard string, row int, start int, length int"


def pack(docs: DataFrame, folder: str, row_tokens: int = ROW_TOKENS, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Write shards into ``folder``; one row per segment: doc_id, part, shard, row, start, length.

    Lazy, and each run writes shards of its own: write the result once before using the files.
    """
    table = read_ranks(ranks)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        codes, held, names, tokens = WordCodes(table), [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in held])
            shifts = np.cumsum([0] + [len(i) for i, _ in held[:-1]])
            ends = np.concatenate([e + s for (_, e), s in zip(held, shifts)])
            shard, segments = pack_window(ids, ends, row_tokens)
            name = uuid.uuid4().hex
            for suffix, array in shard.items():
                with fs.open_output_stream(f"{path}/{name}.{suffix}") as f:
                    f.write(array.tobytes())
            own = pa.concat_arrays(names).take(pa.array(segments[:, 0]))
            return pa.RecordBatch.from_arrays(
                [own, pa.array(segments[:, 1], pa.int32()), pa.array([name] * len(segments)), *[pa.array(segments[:, c], pa.int32()) for c in (2, 3, 4)]],
                names=["doc_id", "part", "shard", "row", "start", "length"],
            )

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in slices(texts):
                held.append(codes.encode(texts[i:j]))
                names.append(batch.column("doc_id").slice(i, j - i))
                tokens += len(held[-1][0])
                if tokens >= WINDOW_TOKENS:
                    yield flush()
                    held, names, tokens = [], [], 0
        if held:
            yield flush()

    return rows.mapInArrow(run, SEGMENTS.format(kind.simpleString()))


def write_manifest(segments: DataFrame, folder: str) -> DataFrame:
    """Write, and return, the shards that count: (shard, rows, segments, tokens). Shards of failed attempts are not in it."""
    spark = segments.sparkSession
    shards = segments.groupBy("shard").agg((F.max("row") + 1).alias("rows"), F.count("*").alias("segments"), F.sum("length").alias("tokens"))
    shards.write.parquet(f"{folder}/manifest")
    return spark.read.schema(shards.schema).parquet(f"{folder}/manifest")


def read_shard(folder: str, name: str, row_tokens: int = ROW_TOKENS) -> dict[str, np.ndarray]:
    fs, path = open_folder(folder)
    kinds = {"ids": "<u2", "cu": "<i4", "at": "<i8", "reset": "<i8"}
    out = {}
    for suffix, kind in kinds.items():
        with fs.open_input_file(f"{path}/{name}.{suffix}") as f:
            out[suffix] = np.frombuffer(f.read(), dtype=kind)
    out["ids"], out["reset"] = out["ids"].reshape(-1, row_tokens), out["reset"].reshape(-1, 3)
    return out


def position_ids(shard: dict[str, np.ndarray], row: int) -> np.ndarray:
    """Positions of a row's tokens: they start anew at every segment, at its place in its document."""
    out = np.arange(shard["ids"].shape[1])
    for _, start, token in sorted(shard["reset"][shard["reset"][:, 0] == row].tolist(), key=lambda r: r[1]):
        out[start:] = np.arange(len(out) - start) + token
    return out
