import random
import re
import time
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from venueflow.llm import packing, sentencepieces, tokenfiles
from venueflow.session import materialize, new_shared_path
from llm_fixtures import docs, empty  # noqa: F401

SF = "/root/testdata/sf0.001"
EDGES = ["", "a", " ", "  ", "   a  b ", "Hello  world\nfoo é 😀", "\n\n x", "a\n b", "    " * 7 + "x", "日本語テキスト 中文", "\t\ttab", "\x00", " \n  \n ", "a" * 3000, "word " * 5000, "x\r\ny"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("aabcdeèth in er on  \n.,!?123éß😀日") for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_same_ids_as_the_library(library):
    encoder = sentencepieces.Encoder(sentencepieces.read_vocabulary())
    texts = EDGES + random_texts(2000)
    flat, ends = encoder.encode(texts)
    for text, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert flat[a:b].tolist() == library.encode(text), text


def test_text_without_blanks_equals_the_library(library):
    rng = random.Random(12)
    letters = "的一是不了人我在有他这为之大来以个中上们日本語テキスト가나다라ёжик😀aāéß0123.,-=/"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (1, 5, 23, 24, 25, 26, 60, 200, 999, 3000) for _ in range(12)]
    texts += ["".join(rng.choice("aabeinrst") for _ in range(400)) for _ in range(20)] + ["=" * 500, "ab" * 300, "的" * 700, "\n".join(["没有空格的句子" * 9] * 5)]
    encoder = sentencepieces.Encoder(sentencepieces.read_vocabulary())
    flat, ends = encoder.encode(texts)
    for text, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert flat[a:b].tolist() == library.encode(text), text


def test_text_without_blanks_costs_little_more_than_spaced_text():
    rng = random.Random(2)
    vocabulary = sentencepieces.read_vocabulary()
    ideographs = [chr(c) for c in range(0x4E00, 0x6E00)]
    solid = ["".join(rng.choice(ideographs) for _ in range(8000)) for _ in range(6)]
    spaced = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(1400)) for _ in range(6)]

    def cost(texts):
        encoder = sentencepieces.Encoder(vocabulary)
        begin = time.process_time()
        encoder.encode(texts)
        return (time.process_time() - begin) / sum(map(len, texts))

    assert cost(solid) < 10 * cost(spaced)


def test_remembered_pieces_stay_below_their_bound(monkeypatch, library):
    monkeypatch.setattr(sentencepieces, "KNOWN_CHARS", 20_000)
    encoder = sentencepieces.Encoder(sentencepieces.read_vocabulary())
    rng = random.Random(4)
    for _ in range(30):
        texts = [" ".join(f"w{rng.random()}" for _ in range(30)) + "a" * rng.choice([1, 1200]) for _ in range(10)]
        flat, ends = encoder.encode(texts)
        assert flat[: ends[0]].tolist() == library.encode(texts[0])
        assert sum(map(len, encoder.number)) <= 20_000 and all(len(w) <= sentencepieces.LONGEST_KNOWN for w in encoder.number)


def test_whole_table_and_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = sentencepieces.decode(sentencepieces.encode(docs)).collect()
    assert all(r["ids"] == library.encode(r["text"]) and r["decoded"] == r["text"] for r in out) and len(out) == docs.count()


def test_decoding_takes_little_more_memory_than_its_texts():
    pieces = sentencepieces.read_vocabulary().out
    long = [i for i, x in enumerate(pieces) if len(x) >= 12]
    ids = np.resize(np.array(long, dtype=np.int32), 400_000)
    decoder, size = sentencepieces.Decoder(pieces), sum(len(pieces[i]) for i in ids.tolist())
    tracemalloc.start()
    try:
        texts = decoder.decode(ids, np.array([len(ids) // 3, len(ids)]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    halves = np.split(ids, [len(ids) // 3])
    assert texts == [b"".join([pieces[i] for i in x.tolist()]).decode().replace("▁", " ").removeprefix(" ") for x in halves]
    assert peak < 10 * size  # 25 and more when the places of all bytes are held at once


def test_small_slices_and_steps_change_nothing(docs, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "SLICE_CHARS", 50)
    monkeypatch.setattr(sentencepieces, "STEP_IDS", 7)
    texts = [None, *EDGES, None, *random_texts(200, 5), ""]
    out = sentencepieces.decode(sentencepieces.encode(docs(texts))).orderBy("doc_id").collect()
    assert [r["ids"] for r in out] == [None if t is None else library.encode(t) for t in texts]
    assert [r["decoded"] for r in out] == texts


def test_edge_rows(docs, empty):
    rows = docs(["▁a", None, "", "same", "same"]).withColumnRenamed("lang", "row").withColumnRenamed("source", "IDS")
    out = sentencepieces.decode(sentencepieces.encode(rows)).orderBy("doc_id").collect()
    assert [r["decoded"] for r in out] == [" a", None, "", "same", "same"] and out[1]["ids"] is None and out[2]["ids"] == []
    assert sentencepieces.encode(empty).count() == 0


def test_byte_pair_ids_of_words_equal_those_of_texts():
    codes = tokenfiles.WordCodes(tokenfiles.read_ranks())
    texts = [None, *EDGES, *random_texts(2000, 2)]
    flat, ends = codes.encode(texts)
    for text, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert flat[a:b].tolist() == [*codes.encoding.encode_ordinary(text or ""), tokenfiles.END]


def test_remembered_words_stay_below_their_bound(monkeypatch):
    monkeypatch.setattr(tokenfiles, "KNOWN_CHARS", 60_000)
    codes = tokenfiles.WordCodes(tokenfiles.read_ranks())
    rng = random.Random(6)
    most = 0
    for _ in range(100):
        texts = [f"{rng.random()}\n\nword  {rng.random()} \t and more " + "q" * rng.choice([1, 3000]) for _ in range(100)]
        flat, ends = codes.encode(texts)
        most = max(most, sum(map(len, codes.number)))
        assert all(len(w) <= tokenfiles.LONGEST_KNOWN for w in codes.number)
        assert flat[: ends[0]].tolist() == [*codes.encoding.encode_ordinary(texts[0]), tokenfiles.END]
    assert most <= 60_000 + sum(map(len, texts))


def test_texts_with_odd_blanks_are_cut_into_words():
    codes = tokenfiles.WordCodes(tokenfiles.read_ranks())
    text = "\n\n".join(f"line {i} of  text\twith tabs \u00a0 and more" for i in range(500))
    words = codes._words(text)
    assert "".join(words) == text and max(map(len, words)) < 20


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_separator_scan_stitches_blocks(spark, block):
    folder = new_shared_path(spark, "scan")
    fs, path = tokenfiles.open_folder(folder)
    fs.create_dir(path)
    contents = {"a": [9, 9, 0, 0, 5, 0, 7], "b": [0], "c": [1, 2, 3, 4, 5], "d": [], "e": [0, 0, 1, 2, 0]}
    for name, ids in contents.items():
        with fs.open_output_stream(f"{path}/{name}") as f:
            f.write(np.array(ids, dtype="<u2").tobytes())
    files = spark.createDataFrame([(n,) for n in contents], "file string")
    got = sorted(tuple(r) for r in tokenfiles.scan_files(spark, files, folder, end=0, block=block).collect())
    want = []
    for name, ids in contents.items():
        parts = "".join("|" if i == 0 else "x" for i in ids).split("|")
        want += [(name, k, len(p), False) for k, p in enumerate(parts[:-1])] + ([(name, len(parts) - 1, len(parts[-1]), True)] if parts[-1] else [])
    assert got == sorted(want)


def test_token_counts(spark, docs, empty):
    codes = tokenfiles.WordCodes(tokenfiles.read_ranks())
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: len(codes.encoding.encode_ordinary(r["text"])) for r in table.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in tokenfiles.token_counts(table).collect()} == want
    assert sorted(r["n_tokens"] for r in tokenfiles.token_counts(docs([None, "", "hi", "hi"], ids=[None, 1, 2, 2])).collect()) == [0, 0, 1, 1]
    assert tokenfiles.token_counts(empty).count() == 0


def plain_best_fit(lengths, room):
    free, out = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(f, -k) for k, f in enumerate(free) if f >= lengths[i]]
        if fits:
            k = -min(fits)[1]
        else:
            k = len(free)
            free.append(room)
        out[i] = k
        free[k] -= lengths[i]
    return out, len(free)


def test_best_fit_decreasing_uses_as_few_rows_as_the_plain_search():
    rng = random.Random(3)
    for room in (1, 7, 64, 100):
        lengths = [rng.randint(1, room) for _ in range(300)]
        rows = packing.best_fit(lengths, room)
        used = np.bincount(rows, weights=lengths)
        assert used.max() <= room and len(used) == plain_best_fit(lengths, room)[1]


def test_packing_is_lossless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10**6, None), (10**6 + 1, "")], "doc_id long, text string"))
    folder = new_shared_path(spark, "packed")
    segments = materialize(packing.pack(docs, folder, row_tokens=256), "segments")
    codes = tokenfiles.WordCodes(tokenfiles.read_ranks())
    shards = {r["shard"]: packing.read_shard(folder, r["shard"], 256) for r in segments.select("shard").distinct().collect()}
    listed = {r["shard"]: (r["rows"], r["segments"], r["tokens"]) for r in packing.write_manifest(segments, folder).collect()}
    assert set(listed) == set(shards) and sum(x[2] for x in listed.values()) == sum(r["length"] for r in segments.collect())
    assert all(listed[k][0] == len(shards[k]["ids"]) for k in shards)
    parts = {}
    for r in segments.collect():
        shard = shards[r["shard"]]
        at = shard["at"][r["row"]]
        end = shard["at"][r["row"] + 1] if r["row"] + 1 < len(shard["at"]) else len(shard["cu"])
        cu = shard["cu"][at:end].tolist()
        assert cu[0] == 0 and cu[cu.index(r["start"]) + 1] == r["start"] + r["length"]
        assert packing.position_ids(shard, r["row"])[r["start"]] == 256 * r["part"]
        parts.setdefault(r["doc_id"], {})[r["part"]] = shard["ids"][r["row"], r["start"] : r["start"] + r["length"]].tolist()
    for r in docs.collect():
        whole = [x for _, p in sorted(parts[r["doc_id"]].items()) for x in p]
        assert whole == [*codes.encoding.encode_ordinary(r["text"] or ""), tokenfiles.END]


def test_packing_an_empty_table(empty, spark):
    assert packing.pack(empty, new_shared_path(spark, "packed")).count() == 0
