"""Flat token files: writing them, and counting tokens by scanning for end-of-document identifiers.

Texts become byte-pair ids, each document closed by the end-of-document id, in flat files of 16-bit
numbers without any index. The count reads such files block by block: NumPy finds the separators of
a block at once, and documents that cross blocks are stitched by a running maximum over the last
separator of the blocks before (one row per block).

Files lie in the shared folder and are reached through the file system its address names. Every
attempt of a task writes files of its own; only those of the attempt that counted are listed.

Defined results: null and empty texts have no tokens but still their separator; a document of any
length is stitched whole; repeated rows and null ids count on their own; tokens after a file's last
separator come back as an open document; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venueflow.session import materialize, new_shared_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern this vocabulary cuts texts with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
FILE_TOKENS = 32 << 20  # a file is closed after the document that passes this
BLOCK_TOKENS = 1 << 20  # tokens scanned at a time
SLICE_CHARS = 4 << 20
KNOWN_CHARS = 12 << 20  # characters of remembered words, each counted with what it costs besides
WORD_COST = 16
LONGEST_KNOWN = 1 << 10  # longer words are encoded each time
# Words of any text: white space, then other characters up to a blank or line end. Other white space may stand inside.
WORDS = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+")
OTHER_BLANKS = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
LOOSE = re.compile(r"\s\s|^\s|\s$| [^\S ]|[^\S ] ")  # blanks that a cut at single blanks would tear apart


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class WordCodes:
    """Byte-pair ids of texts, from the ids of their words, which are remembered within a bound on their characters.

    No piece of the pattern reaches over the start of a blank or line end that follows another
    character, so every text is cut there: one with single blanks only by a plain split, others by
    ``WORDS``. What stands between two cuts is a word, however long; long ones are not remembered.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.start, self.size = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        encode = self.encoding.encode_ordinary  # the batch call hands every word to a thread, which costs more than the word
        codes = [encode(w) for w in words]
        sizes = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes))
        first = len(self.number) - len(words)
        while self.used + sizes.sum() > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.number) > len(self.start):
            self.start, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size))
        self.flat[self.used : self.used + sizes.sum()] = [c for code in codes for c in code]
        self.start[first : first + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[first : first + len(words)] = sizes
        self.used += int(sizes.sum())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by END, in one array; and where each ends."""
        number, numbers, ends, new = self.number, [], [], []
        for text in texts:
            for w in self._words(text or ""):
                k = number.get(w)
                if k is None:
                    number[w] = k = len(number)
                    new.append(w)
                numbers.append(k)
            numbers.append(-1)
            ends.append(len(numbers))
        if new:
            self._learn(new)
            self.chars += sum(map(len, new)) + WORD_COST * len(new)
        picked = np.asarray(numbers, dtype=np.int64)
        sizes = np.where(picked < 0, 1, self.size[picked])
        before = np.concatenate(([0], np.cumsum(sizes)))
        spread = np.repeat(self.start[picked] - before[:-1], sizes) + np.arange(before[-1])
        ids = self.flat[np.where(np.repeat(picked < 0, sizes), 0, spread)]
        ids[before[1:][picked < 0] - 1] = END
        if self.chars > KNOWN_CHARS or any(len(w) > LONGEST_KNOWN for w in new):
            self.forget()
        return ids, before[np.asarray(ends, dtype=np.int64)]

    def _loose(self, text: str) -> bool:
        if OTHER_BLANKS.search(text):
            return LOOSE.search(text) is not None
        ends = text[0] in " \n" or text[-1] in " \n"  # plain searches, several times faster than the pattern
        return ends or "  " in text or " \n" in text or "\n " in text or "\n\n" in text

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        if self._loose(text):
            return WORDS.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about SLICE_CHARS characters each; a longer text stands alone."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t or "") > SLICE_CHARS:
            yield start, i
            start, chars = i, 0
        chars += len(t or "")
    if start < len(texts):
        yield start, len(texts)


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder's address and the path in it."""
    address = re.sub(r"^file:/+", "file:///", folder)
    return pa.fs.FileSystem.from_uri(address)


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """Write flat files into ``folder``; (doc_id, file, nth) says where each document went.

    Lazy: write the result once (``materialize``) before reading the files it names.
    """
    table = read_ranks(ranks)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        fs.create_dir(path, recursive=True)
        codes, sink, name, tokens, nth = WordCodes(table), None, "", 0, 0
        try:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                for i, j in slices(texts):
                    if sink is None:
                        name, tokens, nth = uuid.uuid4().hex, 0, 0
                        sink = fs.open_output_stream(f"{path}/{name}")
                    ids, ends = codes.encode(texts[i:j])
                    sink.write(ids.astype("<u2").tobytes())
                    n = j - i
                    if tokens + len(ids) >= FILE_TOKENS:
                        sink.close()
                        sink = None
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, n), pa.array([name] * n), pa.array(np.arange(nth, nth + n), pa.int64())], names=["doc_id", "file", "nth"]
                    )
                    tokens, nth = tokens + len(ids), nth + n
        finally:
            if sink is not None:
                sink.close()

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, file string, nth long")


def scan_block(ids: np.ndarray, end: int = END) -> tuple[int, int, np.ndarray]:
    """(tokens before the first separator, tokens after the last, lengths between separators)."""
    at = np.flatnonzero(ids == end)
    if not len(at):
        return len(ids), len(ids), np.zeros(0, dtype=np.int64)
    return int(at[0]), len(ids) - 1 - int(at[-1]), np.diff(at) - 1


def scan_files(spark: SparkSession, files: DataFrame, folder: str, end: int = END, block: int | None = None) -> DataFrame:
    """(file, nth, n_tokens, open) of every document in the flat files named by ``files(file)``."""
    step = block or BLOCK_TOKENS

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            names = batch.column("file").to_pylist()
            tokens = [x.size // 2 for x in fs.get_file_info([f"{path}/{n}" for n in names])]
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(tokens, pa.int64())], names=["file", "tokens"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        for batch in batches:
            found = []
            for name, at, tokens in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "tokens"))):
                with fs.open_input_file(f"{path}/{name}") as f:
                    ids = np.frombuffer(f.read_at(2 * min(step, tokens - at * step), 2 * at * step), dtype="<u2")
                found.append((len(ids), int((ids == end).sum()), *scan_block(ids, end)))
            n, seps, head, tail, inner = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), *[pa.array(x, pa.int64()) for x in (n, seps, head, tail)], pa.array(list(inner), pa.list_(pa.int64()))],
                names=["file", "block", "n", "seps", "head", "tail", "inner"],
            )

    blocks = files.select("file").mapInArrow(sizes, "file string, tokens long").filter("tokens > 0")
    blocks = blocks.select("file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / step))).alias("block"))
    blocks = blocks.repartition("file", "block").mapInArrow(scan, "file string, block long, n long, seps long, head long, tail long, inner array<long>")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The prefix scan: documents that ended before this block, and where the last of them ended.
    stitched = blocks.select(
        "*", F.coalesce(F.sum("seps").over(earlier), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max(F.when(F.col("seps") > 0, F.col("block") * step + F.col("n") - F.col("tail"))).over(earlier), F.lit(0)).alias("open_since"),
        (F.col("block") == F.max("block").over(Window.partitionBy("file"))).alias("last"),
    )
    carried = F.col("block") * step - F.col("open_since")
    lengths = F.when(F.col("seps") > 0, F.concat(F.array(F.col("head") + carried), F.col("inner"))).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("seps") > 0, F.col("tail")).otherwise(F.col("n") + carried)
    closed = stitched.select("file", "docs_before", F.posexplode(lengths).alias("i", "n_tokens"))
    closed = closed.select("file", (F.col("docs_before") + F.col("i")).alias("nth"), "n_tokens", F.lit(False).alias("open"))
    opened = stitched.filter(F.col("last") & (rest > 0)).select("file", (F.col("docs_before") + F.col("seps")).alias("nth"), rest.alias("n_tokens"), F.lit(True).alias("open"))
    return closed.union(opened)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and n_tokens of every row, counted in flat files that are written first."""
    spark = docs.sparkSession
    folder = new_shared_path(spark, "token-files")
    placed = materialize(write_tokens(docs, folder, doc_id, text), "token-places")
    counted = scan_files(spark, placed.select("file").distinct(), folder)
    # Both sides grow with the table but compress well, so Spark would underrate them: no broadcast.
    return placed.join(counted.hint("merge"), ["file", "nth"]).select("doc_id", "n_tokens")
