import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from venueflow.llm import pii
from llm_fixtures import docs, empty  # noqa: F401

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        if 14 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


@pytest.mark.parametrize("letters", ["a1.@- +()", "0123456789", "01.", "12 -", "+1 ().-", "a@.b", "é9٣@a."])
def test_base_spans_of_random_texts(letters):
    rng = random.Random(letters)
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("0" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1(" * 100_000, "a@" * 150_000):
        pii.candidates(text)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        base = plain(text[r["doc_id"]])
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(listed) <= set(r["spans"].split(",") if r["spans"] else [])


def test_added_spans_and_masks(docs):
    # A valid number hidden by its neighbour is added, an invalid one is not.
    texts = [f"mail a{i}@mail.example.com or 4111111111111111 from 10.0.0.{i} or +1 (555) 555-01{i:02d} ok" for i in range(60)]
    texts += ["call +1 (826) 555-4081 190.137.223.204 now", "id 4111111111111112 stays", None, "", "plain words"]
    rows = docs(texts)
    spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(rows).collect()}
    assert "phone:5:22" in spans[60] and spans[61] == "" and spans[62] == "" and spans[64] == ""
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.mask_pii(rows).collect()}
    assert masked[0][0] == "mail [EMAIL] or [CARD] from [IP] or [PHONE] ok" and masked[0][1] == len(masked[0][0])
    assert masked[60][0] == "call [PHONE] [IP] now" and masked[62] == (None, None) and masked[64][0] == "plain words"


def test_written_out_addresses_are_taken_whole():
    long = "x" * 80 + " (at) " + "y" * 90 + " (dot) " + "z" * 70
    for text in (long, f"write to {long} soon"):
        start = text.index("x" * 80)
        assert [(s, k, e) for s, k, e, base, *_ in pii.candidates(text) if not base] == [(start, 0, start + len(long))]


def test_added_spans_never_reach_into_base_spans():
    text = "1.1.1.1+2.2.2.2+3.3.3.3+4.4.4.4+5.5.5.5+4111111111111111@example.com"
    got = pii.candidates(text)
    assert (0, 0, len(text), True) in [c[:4] for c in got] and all(c[3] for c in got)
    rng = random.Random(8)
    parts = ["4111111111111111", "10.0.0.1", "a@b.co", " (at) ", "x", ".", "@", "-", " ", "+1 555-555-0101", "(555) 555-0101", "c.de"]
    for _ in range(2000):
        found = pii.candidates("".join(rng.choice(parts) for _ in range(rng.randint(1, 14))))
        base = [c for c in found if c[3]]
        assert not [(b, c) for b in base for c in found if not c[3] and c[0] < b[2] and b[0] < c[2]]


def plain_hidden(text):
    """Written-out addresses by trying every start and the longest domain."""
    out = []
    for m in re.finditer(r"[(\[{] ?[aA][tT] ?[)\]}]", text):
        at = m.start() - (m.start() > 0 and text[m.start() - 1] == " ")
        local = re.search(r"[A-Za-z0-9._%+-]*$", text[:at]).group()
        tail = re.match(r" ?[A-Za-z0-9-]+(?: ?[(\[{] ?[dD][oO][tT] ?[)\]}] ?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)+", text[m.end() :])
        if local and tail:
            out.append((at - len(local), m.end() + tail.end()))
    return out


def test_written_out_addresses_of_random_texts():
    rng = random.Random(3)
    parts = ["ab", "q.r", " ", "(at)", " (at) ", "[ at ]", "(dot)", " (dot) ", ".", "com", "-", "é", "x" * 70]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        want, free = [], 0
        for s, e in plain_hidden(text):
            if s >= free:
                want.append((s, e))
                free = e
        assert [(s, e) for s, k, e, base, *_ in pii.candidates(text) if not base] == want, text


def test_nothing_of_a_span_is_left_in_a_masked_text(docs):
    names = ["n" * 70 + str(i) for i in range(40)]
    rows = docs([f"mail {n} (at) {'d' * 66}{i} (dot) com please" for i, n in enumerate(names)] + ["plain", None, ""])
    model_spans = {r["doc_id"]: r["spans"] for r in pii.find_pii(rows).collect()}
    for r in pii.mask_pii(rows.withColumnRenamed("lang", "row").withColumnRenamed("source", "found")).collect():
        if r["doc_id"] < 40:
            assert ("nnn" in r["text"]) == (model_spans[r["doc_id"]] == "") and r["n_chars"] == len(r["text"])
            assert model_spans[r["doc_id"]] in ("", f"email:5:{len(f'mail {names[r.doc_id]} (at) ' + 'd' * 66 + str(r.doc_id) + ' (dot) com')}")


def test_map_columns_pass_through_masking(docs):
    rows = docs(["a@b.co", None]).withColumn("m", F.create_map(F.lit("k"), F.lit("v")))
    assert [(r["text"], r["m"]) for r in pii.mask_pii(rows).orderBy("doc_id").collect()] == [("[EMAIL]", {"k": "v"}), (None, {"k": "v"})]


def test_empty_table(empty):
    assert pii.find_pii(empty).count() == 0 and pii.mask_pii(empty).columns == empty.columns
