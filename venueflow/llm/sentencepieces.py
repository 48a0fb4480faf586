"""SentencePiece encoding and decoding with a batched Viterbi in NumPy.

The given model is a merge (BPE) model, whose segmentation is not the one with the best sum of piece
scores. It has another property that a Viterbi can use: cutting a text after any prefix, there is
exactly one last piece, the one that is *stable* next to the last piece of what stands before it
(merging by rank from single characters gives these two pieces again). So the lattice keeps one
state per position, and the maximum over the pieces ending there picks the stable one.

A batch's distinct words are put side by side in blocks, longest first, and advance together,
position by position, the shorter ones stopping earlier: hashes of the last 1 to 16 characters come
from prefix hashes, probe the sorted piece keys, and hits are compared character by character.
Stability is found by undoing merges on both sides of the cut, for all new pairs at once, and kept
in a table. Words longer than ``CUT_CHARS`` are first cut between neighbouring characters that stand
side by side in no piece: no merge can reach over such a place, so text without blanks is short
words too.

Words are cut before blanks and around line ends, which no piece of the model crosses (checked when
the model is read). Runs of blanks merge last and from the left; they are encoded apart.

Defined results: a null text has null ids and decodes to null; an empty text has no ids; a character
outside the model becomes its UTF-8 bytes; the character U+2581 decodes as a blank; otherwise
decoding gives the text back. Very long texts and words are encoded whole; repeated rows and null
ids are handled row by row; other columns pass through.

Texts and ids of a batch are handled in slices of about ``SLICE_CHARS``; ids become bytes ``STEP_IDS``
at a time, also within one long text.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CHUNKS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd; prefix hashes are polynomials in it modulo 2^64
SPREAD = np.uint64(0xD6E8FEB86659FD93)
PAIR_SLOTS = 1 << 20  # stability of pairs seen lately
CELLS = 1 << 21  # characters of a group that advance at a time
KNOWN_CHARS = 9 << 20  # characters of the words whose ids a task keeps, each counted with what it costs besides
WORD_COST = 16
LONGEST_KNOWN = 1 << 10  # longer words are encoded each time
CUT_CHARS = 24  # longer words are cut where no piece can cross
SLICE_CHARS = 1 << 20  # text, or ids, handled at a time, whole rows only
STEP_IDS = 1 << 16  # ids whose bytes are taken at a time


def merge(symbols: list[str], score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge neighbours by best score, leftmost first, until none is a piece; and the last merge made."""
    n = len(symbols)
    parts, after, before, last = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), None
    heap = [(-score[a + b], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if parts[i] == a else n
        if j >= n or parts[j] != b:
            continue
        parts[i], parts[j], last = a + b, "", (a, b)
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (c := parts[i] + parts[after[i]]) in score:
                heapq.heappush(heap, (-score[c], i, parts[i], parts[after[i]]))
        if before[i] >= 0 and (c := parts[before[i]] + parts[i]) in score:
            heapq.heappush(heap, (-score[c], before[i], parts[before[i]], parts[i]))
    return [p for p in parts if p], last


@dataclass
class Vocabulary:
    """The model as arrays. Pieces are numbered by rank: single characters first, then in merge order."""

    ids: np.ndarray  # rank -> piece id
    left: np.ndarray  # rank -> rank of the left half of its last merge (itself for a character)
    right: np.ndarray
    size: np.ndarray  # rank -> characters
    hash: np.ndarray  # rank -> polynomial hash
    codes: np.ndarray  # rank -> its characters, padded with zeros
    keys: np.ndarray  # sorted keys of all ranks
    key_rank: np.ndarray
    runs: dict[str, float]  # scores of the pieces that are blanks only
    run_ids: dict[str, int]
    sides: np.ndarray  # sorted pairs of characters that stand side by side in a piece
    byte_ids: np.ndarray  # byte -> piece id
    out: list[bytes]  # piece id -> its bytes

    @property
    def longest(self) -> int:
        return self.codes.shape[1]


def key(h: np.ndarray, size) -> np.ndarray:
    return h ^ (np.asarray(size).astype(np.uint64) * SPREAD)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def pairs_of(codes: np.ndarray) -> np.ndarray:
    """Each character with the next one, as one number."""
    return (codes[:-1].astype(np.uint64) << np.uint64(21)) | codes[1:].astype(np.uint64)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    marks = (codes.astype(np.uint64) + np.uint64(1)) * SPREAD
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + marks[:, i]
    return out


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte_ids, out, normal = np.zeros(256, dtype=np.int32), [b""] * n, {}
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            out[i] = bytes([int(piece[3:5], 16)])
        elif sp.is_unknown(i):
            out[i] = " ⁇ ".encode()
        elif not sp.is_control(i) and not sp.is_unused(i):
            normal[piece] = i
            out[i] = piece.encode()
    runs = {p: sp.get_score(i) for p, i in normal.items() if len(p) > 1 and not p.strip(BLANK)}
    score = {p: sp.get_score(i) for p, i in normal.items() if len(p) > 1 and p not in runs}
    crossing = [p for p in score if BLANK in p[1:] or "\n" in p]
    if crossing or not byte_ids.all() or len(set(score.values())) < len(score):
        raise ValueError(f"a merge model with bytes, whose pieces stay inside words, is needed; got {crossing[:3]}")
    splits = {}
    for p in score:
        parts, last = merge(list(p), score)
        if len(parts) == 1:  # other pieces are never reached by merging
            splits[p] = last
    ordered = sorted(p for p in normal if len(p) == 1) + sorted(splits, key=lambda p: -score[p])
    rank = {p: r for r, p in enumerate(ordered)}
    size = np.array([len(p) for p in ordered], dtype=np.int32)
    codes = np.zeros((len(ordered), size.max()), dtype=np.uint32)
    hashes = np.zeros(len(ordered), dtype=np.uint64)
    for length in range(1, size.max() + 1):
        own = np.flatnonzero(size == length)
        if len(own):
            codes[own, :length] = points = code_points("".join([ordered[r] for r in own])).reshape(len(own), length)
            hashes[own] = prefix_hashes(points)[:, -1]
    keys = key(hashes, size)
    order = np.argsort(keys)
    if (keys[order][1:] == keys[order][:-1]).any():
        raise ValueError("two pieces share a hash")
    halves = [splits.get(p, (p, p)) for p in ordered]
    sides = np.unique(np.concatenate([pairs_of(code_points(p)) for p in normal if len(p) > 1]))
    return Vocabulary(
        ids=np.array([normal[p] for p in ordered], dtype=np.int32),
        left=np.array([rank[a] for a, _ in halves], dtype=np.int32), right=np.array([rank[b] for _, b in halves], dtype=np.int32),
        size=size, hash=hashes, codes=codes, keys=keys[order], key_rank=order.astype(np.int32),
        runs=runs, run_ids={p: normal[p] for p in (*runs, BLANK)}, sides=sides, byte_ids=byte_ids, out=out,
    )


class Encoder:
    """Encodes texts with a vocabulary; keeps what it has learned about words and pairs, within bounds."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.pow = powers(vocabulary.longest)
        self.maybe = np.zeros(1 << 20, dtype=bool)  # first 20 bits of the keys, to spare most probes
        self.maybe[vocabulary.keys >> np.uint64(44)] = True
        self.pair_key = np.zeros(PAIR_SLOTS, dtype=np.int64)
        self.pair_ok = np.zeros(PAIR_SLOTS, dtype=bool)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.new: list[str] = []
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.start, self.size = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)

    def find(self, h: np.ndarray, size) -> np.ndarray:
        """Rank of the piece with this hash and length, or -1; hits still need a look at their characters."""
        wanted = key(h, size)
        out = np.full(wanted.shape, -1, dtype=np.int32)
        some = np.nonzero(self.maybe[wanted >> np.uint64(44)])
        probed = wanted[some]
        at = np.searchsorted(self.v.keys, probed)
        at[at == len(self.v.keys)] = 0
        out[some] = np.where(self.v.keys[at] == probed, self.v.key_rank[at], -1)
        return out

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging gives pieces a and b side by side; unknown characters (negative) never merge."""
        ok = (a < 0) | (b < 0)
        todo = np.flatnonzero(~ok)
        pair = a[todo].astype(np.int64) * len(self.v.ids) + b[todo] + 1
        slot = ((pair.astype(np.uint64) * BASE) >> np.uint64(44)).astype(np.int64)
        known = self.pair_key[slot] == pair
        ok[todo[known]] = self.pair_ok[slot[known]]
        fresh, first, back = np.unique(pair[~known], return_index=True, return_inverse=True)
        if len(fresh):
            at = todo[~known]
            judged = self._undo(a[at[first]], b[at[first]])
            ok[at] = judged[back]
            self.pair_key[slot[~known]], self.pair_ok[slot[~known]] = pair[~known], ok[at]
        return ok

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Take back the later of the two merges next to the cut, again and again. If at some time the
        neighbours could have merged across the cut before that, the pair is not stable."""
        v = self.v
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), dtype=bool)
        before = np.full(len(a), len(v.ids) + 1)  # merges across the cut count if they rank below this
        at = np.arange(len(a))
        while len(at):
            x, y = a[at], b[at]
            size = v.size[x] + v.size[y]
            short = size <= v.longest
            across = np.full(len(at), -1)
            across[short] = self.find(v.hash[x[short]] * self.pow[v.size[y[short]]] + v.hash[y[short]], size[short])
            for i in np.flatnonzero((across >= 0) & (across < before[at])):
                both = np.concatenate((v.codes[x[i], : v.size[x[i]]], v.codes[y[i], : v.size[y[i]]]))
                if np.array_equal(v.codes[across[i], : size[i]], both):
                    ok[at[i]] = False
            go = ok[at] & (v.size[np.maximum(x, y)] > 1)
            at, x, y = at[go], x[go], y[go]
            first = x > y
            before[at] = np.where(first, x, y + 1)
            a[at], b[at] = np.where(first, v.right[x], x), np.where(first, y, v.left[y])
        return ok

    def cut(self, word: str) -> list[str]:
        """Parts of a long word that no piece reaches over."""
        codes = code_points(word)
        pairs = pairs_of(codes)
        at = np.minimum(np.searchsorted(self.v.sides, pairs), len(self.v.sides) - 1)
        blank = codes == ord(BLANK)
        free = np.flatnonzero((self.v.sides[at] != pairs) & ~blank[:-1] & ~blank[1:]) + 1
        ends = [0, *free.tolist(), len(word)]
        return [word[i:j] for i, j in zip(ends, ends[1:])]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, which advance together, one word after the other, and each word's number of ids."""
        v, n = self.v, len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        order = np.argsort(-lengths, kind="stable")
        own = lengths[order]
        length = int(own[0])
        codes = np.zeros((n, length), dtype=np.uint32)
        codes[np.arange(length) < own[:, None]] = code_points("".join([words[i] for i in order.tolist()]))
        prefix = prefix_hashes(codes)
        last = np.full((n, length + 1), -1, dtype=np.int64)
        back = np.zeros((n, length + 1), dtype=np.int32)
        for i in range(1, length + 1):
            live = int(np.searchsorted(-own, -i, side="right"))  # words that are long enough
            most = min(i, v.longest)
            sizes = np.arange(1, most + 1)
            rank = self.find(prefix[:live, i, None] - prefix[:live, i - sizes] * self.pow[sizes], np.broadcast_to(sizes, (live, most)))
            w, s = np.nonzero(rank >= 0)
            r = rank[w, s]
            s = s + 1
            same = np.ones(len(w), dtype=bool)
            for k in range(most):
                deep = np.flatnonzero(s > k)
                same[deep] &= v.codes[r[deep], s[deep] - 1 - k] == codes[w[deep], i - 1 - k]
            w, s, r = w[same], s[same], r[same]
            good = (s == i) | self.stable(np.where(s == i, -1, last[w, i - s]), r)
            best = np.zeros(live, dtype=np.int32)
            np.maximum.at(best, w[good], s[good].astype(np.int32))
            chosen = good & (s == best[w])
            last[w[chosen], i] = r[chosen]
            missing = np.flatnonzero(best == 0)  # a character outside the model stands alone
            last[missing, i] = -1 - codes[missing, i - 1].astype(np.int64) - 1
            back[:live, i] = np.where(best == 0, 1, best)
        at, rows, ranks = own.copy(), [], []
        while len(live := np.flatnonzero(at)):
            rows.append(live)
            ranks.append(last[live, at[live]])
            at[live] -= back[live, at[live]]
        rows, ranks = order[np.concatenate(rows[::-1])], np.concatenate(ranks[::-1])
        by_word = np.argsort(rows, kind="stable")
        rows, ranks = rows[by_word], ranks[by_word]
        ids = v.ids[np.maximum(ranks, 0)]
        if (strange := ranks < 0).any():
            bytes_of = [v.byte_ids[list(chr(-r - 2).encode("utf-8", "surrogatepass"))] for r in ranks[strange].tolist()]
            times = np.ones(len(ranks), dtype=np.int64)
            times[strange] = [len(x) for x in bytes_of]
            rows, ids = np.repeat(rows, times), np.repeat(ids, times)
            ids[np.repeat(strange, times)] = np.concatenate(bytes_of)
        return ids, np.bincount(rows, minlength=n)

    def _run(self, n: int) -> list[int]:
        return [self.v.run_ids[p] for p in merge([BLANK] * n, self.v.runs)[0]]

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.number) > len(self.start):
            self.start, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def learn(self) -> None:
        """Encode the new words; those that begin with several blanks, from a word with one."""
        wide = [w for w in self.new if w.startswith(BLANK * 2) or w == BLANK]
        for w in wide:
            if (body := w.lstrip(BLANK)) and BLANK + body not in self.number:
                self.number[BLANK + body] = len(self.number)
                self.new.append(BLANK + body)
        words = sorted((w for w in self.new if not w.startswith(BLANK * 2) and w != BLANK), key=len, reverse=True)
        i = 0
        while i < len(words):
            some = words[i : i + max(1, CELLS // (len(words[i]) * 16))]
            self._keep(np.array([self.number[w] for w in some]), *self.segment(some))
            i += len(some)
        blank = self.v.run_ids[BLANK]
        for w in wide:
            body = w.lstrip(BLANK)
            n = len(w) - len(body)
            own = []
            if body:
                k = self.number[BLANK + body]
                own = self.flat[self.start[k] : self.start[k] + self.size[k]].tolist()
                if own[0] == blank:  # the last blank merged with nothing after it, so it is part of the run
                    own = own[1:]
                else:
                    n -= 1
            ids = np.array(self._run(n) + own, dtype=np.int32)
            self._keep(np.array([self.number[w]]), ids, np.array([len(ids)]))
        self.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text ends."""
        number, numbers, ends, long = self.number, [], [], False
        for text in texts:
            if text:
                for chunk in CHUNKS.findall(BLANK + text.replace(" ", BLANK)):
                    for w in (chunk,) if len(chunk) <= CUT_CHARS else self.cut(chunk):
                        k = number.get(w)
                        if k is None:
                            number[w] = k = len(number)
                            self.new.append(w)
                            self.chars += len(w) + WORD_COST
                            long |= len(w) > LONGEST_KNOWN
                        numbers.append(k)
            ends.append(len(numbers))
        if self.new:
            self.learn()
        picked = np.asarray(numbers, dtype=np.int64)
        sizes = self.size[picked]
        before = np.concatenate(([0], np.cumsum(sizes)))
        spread = np.repeat(self.start[picked] - before[:-1], sizes)
        ids = self.flat[spread + np.arange(before[-1])]
        if long or self.chars > KNOWN_CHARS:
            self.forget()
        return ids, before[np.asarray(ends, dtype=np.int64)]


def runs_of(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about SLICE_CHARS characters, or ids, each; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def sizes_of(column: pa.Array) -> list[int]:
    """Bytes of each text, or ids of each list."""
    count = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return pc.fill_null(count(column), 0).to_pylist()


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with the piece ids of ``text`` in a new array column ``ids`` (replacing one of that name)."""
    vocabulary = read_vocabulary(model)
    names = [c for c in docs.columns if c.lower() != ids.lower()]
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            column = batch.column("text")
            for i, j in runs_of(sizes_of(column)):
                texts = column.slice(i, j - i).to_pylist()
                flat, ends = encoder.encode(texts)
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32), mask=np.array([t is None for t in texts] + [False]))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(flat))], names=["row", "ids"])

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")
    return out.select(*[F.col("row")[c].alias(c) for c in names], F.col("ids").alias(ids))


class Decoder:
    """Texts of id lists, whose bytes are taken from one table for all lists together, ``STEP_IDS`` at a time:
    taking a byte needs some 24 bytes besides."""

    def __init__(self, out: list[bytes]) -> None:
        self.body = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.size = np.array([len(x) for x in out], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def bytes_of(self, ids: np.ndarray) -> bytes:
        sizes = self.size[ids]
        upto = np.cumsum(sizes)
        return self.body[np.repeat(self.start[ids] - upto + sizes, sizes) + np.arange(sizes.sum())].tobytes()

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """One text for each list of ids, which ends at ``ends``."""
        said = b"".join([self.bytes_of(ids[i : i + STEP_IDS]) for i in range(0, len(ids), STEP_IDS)])
        upto = np.concatenate(([0], np.cumsum(self.size[ids], dtype=np.int64)))
        out, begin = [], 0
        for end in upto[ends].tolist():
            text = said[begin:end].decode("utf-8", "replace").replace(BLANK, " ")
            out.append(text[1:] if text.startswith(" ") else text)
            begin = end
        return out


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its ids in a column ``text`` (replacing one of that name)."""
    pieces = read_vocabulary(model).out
    names = [c for c in encoded.columns if c.lower() != text.lower()]
    rows = encoded.select(F.struct(*[encoded[c] for c in names]).alias("row"), encoded[ids].cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pieces)
        for batch in batches:
            sizes = sizes_of(batch.column("ids"))
            for i, j in runs_of(sizes):
                column = batch.column("ids").slice(i, j - i)
                texts = decoder.decode(column.flatten().to_numpy(), np.cumsum(sizes[i:j]))
                masked = pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), masked], names=["row", "decoded"])

    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, decoded string")
    return out.select(*[F.col("row")[c].alias(c) for c in names], F.col("decoded").alias(text))
