"""Token alignment against whole texts encoded by the libraries and grouped by plain set operations."""

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_fixtures import docs, empty  # noqa: F401
from venueflow.llm import alignment
from venueflow.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(alignment.BYTE_MODEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)
    value = alignment.byte_values()
    a_bytes = lambda i: bytes(value[c] for c in a.id_to_token(i))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), a_bytes, b.encode, b_bytes


def cut(tokens, ends):
    """Tokens in groups that end at ``ends``."""
    out, at = [[]], 0
    for i, size in tokens:
        out[-1].append(i)
        at += size
        if at in ends:
            out.append([])
    return out[:-1]


def brute(rows, sides):
    encode_a, a_bytes, encode_b, b_bytes = sides
    grouped = []
    for _, text in rows:
        grouped.append(None)
        if not text:
            continue
        a, b = ([(i, f(i)) for i in e(text)] for e, f in ((encode_a, a_bytes), (encode_b, b_bytes)))
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
            a, b = ([(i, len(x)) for i, x in side] for side in (a, b))
            ends = set(np.cumsum([n for _, n in a]).tolist()) & set(np.cumsum([n for _, n in b]).tolist())
            grouped[-1] = list(zip(cut(a, ends), cut(b, ends)))
    links = [[(i, j) for a, b in g or () for i in a for j in b] for g in grouped]
    count = Counter(p for x in links for p in set(x))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (doc, _), g, x in zip(rows, grouped, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        sha = hashlib.sha256(said.encode()).hexdigest() if g else ""
        sizes = (sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), len(x))
        out.append((doc, *sizes, sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x), sha))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, alignment.align(df).collect()), key=repr)


def sample(seed, n):
    r = random.Random(seed)
    parts = ["a", "b", "the", "Token", " ", "  ", "\n", "\n\n", "\t", " \n", "é", "日本", "'s", "12", "3.", "<s>", "<|endoftext|>", "\xa0", "\x1c", "\x85", "🙂", "　", "----", "    ", "\r\n", "<0x0A>", "\x00", "ﬁ"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_equals_whole_texts_encoded_by_the_libraries(docs, sides):
    texts = sample(4, 600) + [None, "", " ", "\n", "a" * 3000, " " * 2000, "日本語" * 500, "odd ▁ mark", "▁"]
    assert found(docs(texts)) == brute(list(enumerate(texts)), sides)


def test_texts_whose_bytes_are_not_told_have_no_tokens(docs):
    rows = {r[0]: r[1:] for r in found(docs(["the cat", "the ▁ cat", None]))}
    assert rows[1] == rows[2] == (0, 0, 0, 0, 0, 0, "") and rows[0][0] > 0


def test_small_blocks_and_forgetting_change_nothing(docs, sides, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 200)
    monkeypatch.setattr(alignment, "KNOWN_CHARS", 100)
    monkeypatch.setattr(alignment, "LONGEST_KNOWN", 12)
    texts = sample(5, 150)
    assert found(docs(texts)) == brute(list(enumerate(texts)), sides)


def test_repeated_rows_missing_ids_and_other_columns(docs, sides):
    texts, ids = ["one two", "one two", "two one", None, "one"], [1, 1, 1, None, None]
    df = docs(texts, ids=ids).withColumns({"block": F.lit("x"), "pairs": F.create_map(F.lit("k"), F.lit("v")), "n_a": F.lit(1)})
    assert found(df) == brute(list(zip(ids, texts)), sides)


def test_tables_without_tokens(docs, empty):
    assert alignment.align(empty).collect() == []
    assert [r[1:] for r in found(docs([None, ""]))] == [(0, 0, 0, 0, 0, 0, "")] * 2


class Counted:
    """Side A with a count of the texts it is given."""

    def __init__(self, a):
        self.a, self.given = a, 0

    def encode_batch_fast(self, texts, **named):
        self.given += len(texts)
        return self.a.encode_batch_fast(texts, **named)


@pytest.fixture
def aligner():
    tokenizers = alignment.Tokenizers(Path(alignment.BYTE_MODEL).read_text(), Path(alignment.PIECE_MODEL).read_bytes())
    tokenizers.a = Counted(tokenizers.a)
    return alignment.Aligner(tokenizers)


def test_new_chunks_are_encoded_many_at_a_time(aligner):
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("abcdeio.,é") for _ in range(r.randint(2, 9))) for _ in range(200)) for _ in range(30)]
    aligner.align(texts)
    assert len(aligner.number) > 4000 and aligner.t.a.given < len(aligner.number) / 100


@pytest.mark.parametrize("joined", [1, 2, 7])
def test_chunks_encoded_together_have_the_ids_they_have_alone(aligner, monkeypatch, joined):
    monkeypatch.setattr(alignment, "JOINED", joined)
    chunks = [*dict.fromkeys(c for t in sample(7, 300) if t for c in alignment.CHUNKS.findall(" " + t))]
    ids, sizes, whole = aligner.t.encode_a(chunks, [c.encode() for c in chunks])
    ends = np.cumsum(sizes)
    assert whole.all() and ends[-1] == len(ids)
    for c, i, j in zip(chunks, [0, *ends[:-1]], ends):
        assert ids[i:j].tolist() == aligner.t.a.a.encode(c, add_special_tokens=False).ids, c


def test_a_chunk_that_a_does_not_tell_costs_only_its_texts(aligner):
    texts = ["one two", "one Zürich two", "two", "Zürich"]
    whole = aligner.align(texts)
    aligner.forget()
    for i in aligner.t.a.a.encode(" Zürich", add_special_tokens=False).ids:
        aligner.t.a_bytes[i] = b""
    total, digests, doc, *_ = aligner.align(texts)
    assert [bool(d) for d in digests] == [True, False, True, False] and set(doc) == {0, 2}
    assert digests[0] == whole[1][0] and total[[0, 2]].tolist() == whole[0][[0, 2]].tolist() and not total[[1, 3]].any()


def test_one_key_and_two_keys_sort_alike():
    r = np.random.default_rng(1)
    group, value = r.integers(0, 50, 500), r.integers(0, 9, 500)
    for big in (1, 1 << 58):  # times this, both do not fit into one key
        order = alignment._order(group, value * big)
        assert np.array_equal(np.stack((group, value))[:, order], np.stack((group, value))[:, np.lexsort((value, group))])


def test_groups_break_where_both_sides_end():
    a, b = alignment.groups_of(np.array([2, 3, 1, 4]), np.array([2, 1, 1, 2, 2, 2]))
    assert a.tolist() == [0, 1, 1, 2] and b.tolist() == [0, 1, 1, 1, 2, 2]


def test_the_query_equals_plain_python(spark, sides):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, sides)


def test_rows_of_blocks_are_packed_and_few_to_a_file(spark, monkeypatch):
    """Rows of some MB each, thousands to a file, overran the memory of readers."""
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 200)
    monkeypatch.setattr(alignment, "FILE_BLOCKS", 3)
    written = []
    plain = alignment.materialize
    monkeypatch.setattr(alignment, "materialize", lambda *a, **b: written.append(plain(*a, **b)) or written[-1])
    rows = [(i, "the same words said again " * 4) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = alignment.align(df, "doc_id", "text").collect()
    blocks = written[0]
    assert blocks.count() > 10 and blocks.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 3
    assert {f.name for f in blocks.schema if f.dataType.typeName() == "array"} == {"pairs", "held"}
    # 40 documents hold every pair that one holds.
    assert sorted(r["doc_id"] for r in out) == list(range(40)) and {r["count_sum"] for r in out} == {40 * out[0]["n_links"]}
