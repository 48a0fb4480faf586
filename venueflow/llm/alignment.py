"""Alignment of two tokenizers over the same texts, by coalescing byte intervals.

Tokens of both tokenizers are byte intervals. All intervals are lexsorted by start, the running
maximum of their ends is accumulated, and a group breaks where a start reaches that maximum: just
where tokens of both sides end. Within a group every A token is linked with every B token.

Texts are cut into chunks before a blank or line end that follows another character. No token of
either side reaches over such a cut (checked for the merge model when it is read), so a chunk's
tokens, groups and links are worked out once, for many new chunks together, and remembered within a
bound on their characters. A encodes new chunks that may follow one another as one text.

How many documents hold an id pair linked is counted in two steps: each block of documents lists its
pairs once, these lists are summed by pair, and the sums go back to the blocks that asked. A block
holds about ``BLOCK_CHARS`` characters, so a frequent pair is one row a block. The highest count of
each A id is one row per id of the vocabulary. What a block has to remember of its documents until
the sums are back travels packed, and its rows are read a few at a time.

Tokenizers are given as files, read on the driver and sent with the job. A: byte-level BPE, applied
to a blank and the text; B: merge model with bytes, which adds the blank itself.

Defined results: null and empty texts, and texts whose joined tokens of A or B are not the blank and
the text (those with U+2581), have no tokens: all numbers 0, digest ''. Every row is a document of its
own, repeated or without id or not; texts of any length are handled whole; other columns are not
read; an empty table gives an empty one.
"""

from __future__ import annotations

import ctypes
import hashlib
import re
import sys
import uuid
from collections.abc import Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
# Chunks: blanks, then other characters up to a blank or line end; other white space may stand inside.
CHUNKS = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
BLOCK_CHARS = 1 << 21
KNOWN_CHARS = 4 << 20  # characters of remembered chunks
LONGEST_KNOWN = 1 << 10  # longer chunks are worked out each time
JOINED = 1 << 10  # chunks that A encodes as one text
FILE_BLOCKS = 16  # blocks in a file: a Parquet reader decodes all rows of a small file at once
PAIR_BITS = 24  # of the B id in an id pair
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_values() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, byte_model: str, piece_model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_model)
        self.a.encode_special_tokens = True
        value = byte_values()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in value for c in token):
                self.a_bytes[i] = bytes([value[c] for c in token])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace(BLANK, " ").encode())
                if BLANK in piece.lstrip(BLANK) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} reaches over the cuts between chunks")
        self.a_len, self.b_len = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        # Every id as text after each mark that may stand before it.
        self.a_said, self.b_said = (
            np.array([[m + str(i) for i in range(len(x))] for m in marks], dtype=object) for x, marks in ((self.a_bytes, ("", ";", ",")), (self.b_bytes, ("|", ",")))
        )

    def encode_a(self, chunks: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all chunks, each chunk's number of ids, and whether they tell its bytes. Chunks that may follow one
        another in a text are encoded as one, and its ids dealt out by bytes; if they do not tell these, chunk by chunk."""
        ends = [i + 1 for i, c in enumerate(chunks) if c[-1].isspace() or chunks[min(i + 1, len(chunks) - 1)][0] not in " \n"]
        ends = sorted({*ends, *range(JOINED, len(chunks), JOINED), len(chunks)})
        ids = _flat([e.ids for e in self.a.encode_batch_fast(["".join(chunks[i:j]) for i, j in zip([0, *ends], ends)], add_special_tokens=False)])
        if b"".join(map(self.a_bytes.__getitem__, ids.tolist())) == b"".join(raw):
            token_ends = np.cumsum(self.a_len[ids])
            chunk_ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
            at = np.searchsorted(token_ends, chunk_ends)
            if np.array_equal(token_ends[at], chunk_ends):
                return ids, np.diff(at, prepend=-1), np.ones(len(chunks), dtype=bool)
        return _told([e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)], self.a_bytes, raw)

    def encode_b(self, chunks: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode_a``. The model puts a blank before every text: it is the chunk's own first blank, or cut off again with a line end after it."""
        own = [len(c) > 1 and c[0] == " " for c in chunks]
        ids = self.b.encode([c[1:] if o else "\n" + c for c, o in zip(chunks, own)], num_threads=1)
        return _told([x if o else x[2:] for x, o in zip(ids, own)], self.b_bytes, raw)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=sum(map(len, lists)))


def _told(ids: list[list[int]], told: list[bytes], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all chunks, their numbers, and whether their bytes are the chunk's."""
    whole = [b"".join([told[i] for i in x]) == r for x, r in zip(ids, raw)]
    return _flat(ids), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)), np.array(whole)


def ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and every B token, from their lengths in bytes, over the same bytes."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    start = np.concatenate((a_end - a_sizes, b_end - b_sizes))
    end = np.concatenate((a_end, b_end))
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(np.concatenate(([False], start[order][1:] >= reach[:-1])))
    return group[: len(a_end)], group[len(a_end) :]


def links_of(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times): linked id pairs of every group, ids repeated in a group counted together."""
    (ga, ia), ta = _tally(a_group, a_ids)
    (gb, ib), tb = _tally(b_group, b_ids)
    many = np.bincount(gb, minlength=int(ga[-1]) + 1 if len(ga) else 0)
    first = np.cumsum(many) - many
    each = many[ga]
    at = np.repeat(first[ga], each) + ranges(each)
    return np.repeat(ga, each), (np.repeat(ia, each) << PAIR_BITS) | ib[at], np.repeat(ta, each) * tb[at]


def _order(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Positions by group and value, by one key if both fit into it."""
    span = int(value.max(initial=0)) + 1
    if int(group.max(initial=0)) < (1 << 62) // span:
        return np.argsort(group * span + value)
    return np.lexsort((value, group))


def _tally(group: np.ndarray, value: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Different (group, value), sorted, and how often each occurs."""
    order = _order(group, value)
    g, v = group[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (v[1:] != v[:-1])))) if len(g) else np.zeros(0, dtype=np.int64)
    return (g[new], v[new]), np.diff(np.concatenate((new, [len(g)])))


class Numbers(dict):
    """Numbers chunks in the order in which they are first asked for."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = k = len(self)
        return k


class Aligner:
    """Aligns texts chunk by chunk; remembers chunks within bounds."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.t = tokenizers
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.chars = 0
        self.said: list[str | None] = []  # a chunk's groups as text, None if its bytes are not told by the tokens
        self.counts = [np.zeros((0, len(COUNTS)), dtype=np.int64)]
        self.n_pairs, self.pair, self.times = ([np.zeros(0, dtype=np.int64)] for _ in range(3))

    def _learn(self, chunks: list[str]) -> None:
        raw = [c.encode() for c in chunks]
        (a_ids, n_a, a_whole), (b_ids, n_b, b_whole) = self.t.encode_a(chunks, raw), self.t.encode_b(chunks, raw)
        whole = a_whole & b_whole
        if not whole.all():
            a_ids, b_ids = a_ids[np.repeat(whole, n_a)], b_ids[np.repeat(whole, n_b)]
            n_a, n_b = n_a * whole, n_b * whole
        a_group, b_group = groups_of(self.t.a_len[a_ids], self.t.b_len[b_ids])
        total = int(a_group[-1]) + 1 if len(a_group) else 0
        chunk_of = np.zeros(total, dtype=np.int64)
        chunk_of[a_group] = np.repeat(np.arange(len(chunks)), n_a)
        n_groups = np.bincount(chunk_of, minlength=len(chunks))
        g, pair, times = links_of(a_ids, a_group, b_ids, b_group)
        (c, p), t = _sum(chunk_of[g], pair, times)
        self.n_pairs.append(np.bincount(c, minlength=len(chunks)))
        self.pair.append(p)
        self.times.append(t)
        n_links = np.bincount(c, weights=t, minlength=len(chunks)).astype(np.int64)
        self.counts.append(np.stack((n_a, n_b, n_groups, n_links), axis=1))
        opens = np.diff(chunk_of, prepend=-1) > 0  # the first group of a chunk
        a_new, b_new = np.diff(a_group, prepend=-1) > 0, np.diff(b_group, prepend=-1) > 0
        said = np.empty(len(a_ids) + len(b_ids), dtype=object)
        said[np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)] = self.t.a_said[np.where(a_new, np.where(opens[a_group], 0, 1), 2), a_ids]
        said[np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")] = self.t.b_said[np.where(b_new, 0, 1), b_ids]
        said, ends = said.tolist(), np.cumsum(n_a + n_b).tolist()
        self.said += ["".join(said[i:j]) if w else None for i, j, w in zip([0, *ends], ends, whole.tolist())]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts and digest of each text; and (text, pair, times) of its different linked id pairs."""
        if self.chars > KNOWN_CHARS:
            self.forget()
        numbers, ends, first = [], [], len(self.number)
        for text in texts:
            if text:
                numbers += map(self.number.__getitem__, CHUNKS.findall(" " + text))
            ends.append(len(numbers))
        new = list(islice(self.number, first, None))
        self.chars += sum(map(len, new)) + 16 * len(new)
        passing = any(len(c) > LONGEST_KNOWN for c in new)
        if new:
            self._learn(new)
        joined = [x if len(x) == 1 else [np.concatenate(x)] for x in (self.counts, self.n_pairs, self.pair, self.times)]
        self.counts, self.n_pairs, self.pair, self.times = joined
        counts, n_pairs, pair, times = (x[0] for x in joined)
        digests, good = [], np.zeros(len(texts), dtype=bool)
        begin = 0
        for i, end in enumerate(ends):
            said = list(map(self.said.__getitem__, numbers[begin:end]))
            good[i] = bool(said) and None not in said
            digests.append(hashlib.sha256(";".join(said).encode()).hexdigest() if good[i] else "")
            begin = end
        picked = np.asarray(numbers, dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), np.diff([0, *ends]))
        picked, owner = picked[good[owner]], owner[good[owner]]
        total = np.stack([np.bincount(owner, weights=counts[picked, j], minlength=len(texts)).astype(np.int64) for j in range(len(COUNTS))], axis=1)
        (d, k), often = _tally(owner, picked)
        each = n_pairs[k]
        at = np.repeat((np.cumsum(n_pairs) - n_pairs)[k], each) + ranges(each)
        (doc, linked), t = _sum(np.repeat(d, each), pair[at], np.repeat(often, each) * times[at])
        if passing:  # a long chunk is not kept
            self.forget()
        return total, digests, doc, linked, t


def _sum(group: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Different (group, value), sorted, and the sum of their weights."""
    if not len(group):
        return (group, value), weight
    order = _order(group, value)
    g, v = group[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (v[1:] != v[:-1]))))
    return (g[new], v[new]), np.add.reduceat(weight[order], new)


def _blocks(docs: DataFrame, byte_model: str, piece_model: str) -> DataFrame:
    """One row per block of documents: their ids, counts and digests (packed), which of the block's pairs each links how
    often (packed), the pairs, and how many of its documents hold each."""
    models = (Path(byte_model).read_text(), Path(piece_model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(Tokenizers(*models))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in slices(texts):
                counts, digests, doc, linked, times = aligner.align(texts[i:j])
                pairs, at = np.unique(linked, return_inverse=True)
                held = np.bincount(at, minlength=len(pairs))
                own = np.bincount(doc, minlength=j - i)
                rows = [batch.column("doc_id").slice(i, j - i), pa.array(digests, pa.string()), *[pa.array(counts[:, k]) for k in range(len(COUNTS))], pa.array(own)]
                packed = _packed(rows, ["ids", "digests", *COUNTS, "own"]), _packed([pa.array(at.astype(np.int32)), pa.array(times.astype(np.int64))], ["at", "times"])
                columns = [pa.array([x]) for x in (uuid.uuid4().hex, *packed)] + [_one(pa.array(x.astype(np.int64))) for x in (pairs, held)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "rows", "links", "pairs", "held"])
        aligner = None
        _give_back()

    return docs.mapInArrow(run, "block string, rows binary, links binary, pairs array<long>, held array<long>")


def _packed(columns: list[pa.Array], names: list[str]) -> bytes:
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(column: pa.ChunkedArray) -> dict[str, pa.Array]:
    """The columns packed into the only value of ``column``."""
    table = pa.ipc.open_stream(column[0].as_buffer()).read_all()
    return {c: table.column(c).combine_chunks() for c in table.column_names}


def _give_back() -> None:
    """Freed memory goes back to the system: the same Python process also serves the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def _one(values: pa.Array) -> pa.Array:
    """One row with all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about BLOCK_CHARS characters each; a longer text stands alone."""
    start = chars = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and chars + n > BLOCK_CHARS:
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(texts):
        yield start, len(texts)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, docs, best): how many documents hold a pair linked, and whether no pair with its A id is held by more."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("docs"))
    counts = materialize(counts, "pair-counts")
    a_id = F.shiftright("pair", PAIR_BITS)
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    # One row per id of vocabulary A: bounded whatever the number of documents.
    return counts.join(F.broadcast(highest), a_id == F.col("a_id")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    An id pair's count is the number of documents holding it linked. ``n_best`` are the links whose
    count is the highest of their A id, ``count_sum`` sums the counts of all links. The digest is of
    ``a1,a2|b1;a3|b2,b3``: the ids of each group.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    blocks = materialize(_blocks(rows, byte_model, piece_model), "aligned-blocks", file_rows=FILE_BLOCKS)
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("pos", "pair"))
    told = asked.join(pair_counts(blocks).hint("merge"), "pair").select("asker", "pos", "docs", "best")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _unpacked(left.column("rows")) | _unpacked(left.column("links"))
        pos = right.column("pos").to_numpy()
        docs_of, best = np.zeros(len(pos), dtype=np.int64), np.zeros(len(pos), dtype=np.int64)
        docs_of[pos], best[pos] = right.column("docs").to_numpy(), right.column("best").to_numpy()
        at, times = row["at"].to_numpy(), row["times"].to_numpy()
        n = len(row["ids"])
        owner = np.repeat(np.arange(n), row["own"].to_numpy())
        n_best, count_sum = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        np.add.at(n_best, owner, best[at] * times)
        np.add.at(count_sum, owner, docs_of[at] * times)
        return pa.table([row["ids"], *[row[c] for c in COUNTS], pa.array(n_best), pa.array(count_sum), row["digests"]], names=[*OUT])

    schema = f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in OUT[1:-1]) + ", groups_sha256 string"
    blocks = blocks.select("block", "rows", "links")
    return blocks.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(score, schema)


OUT = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
