"""Pseudonyms against a detector that shares no code with the operator; leaks, linear time, odd bytes, wide ids."""

import time
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stockyard.llm import fingerprint, language, pii

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        v = ord(c) - 48
        v = v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
        total += v
    return total % 10 == 0


def remainder(text):
    turned = text[4:] + text[:4]
    number = "".join(c if c in "0123456789" else str("ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c) + 10) for c in turned)
    return int(number) % 97 == 1


def detect(text):
    """(start, end) of card numbers and IBANs, character by character: whole runs between letters and punctuation."""
    spans, n = [], len(text)
    for i in range(n):
        if i and (text[i - 1].isalnum() or text[i - 1] in "_.-"):
            continue
        digits, k = "", i
        while k < n and len(digits) <= 19 and (text[k] in "0123456789" or (text[k] in " -" and k + 1 < n and text[k + 1] in "0123456789" and digits and text[k - 1] in "0123456789")):
            digits += text[k] if text[k] != " " and text[k] != "-" else ""
            k += 1
            closed = k == n or not (text[k].isalnum() or text[k] in "_-")
            if 13 <= len(digits) <= 19 and closed and text[k - 1] not in " -" and luhn(digits):
                spans.append((i, k))
        flat, k = "", i
        while k < n and len(flat) < 34 and (text[k] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" or (text[k] == " " and len(flat) % 4 == 0 and flat and text[k - 1] != " ")):
            flat += text[k].strip()
            k += 1
            closed = k == n or not text[k].isalnum()
            if len(flat) == pii.IBAN_LENGTHS.get(flat[:2]) and closed and text[k - 1] != " " and flat[2:4].isdigit() and remainder(flat):
                spans.append((i, k))
    return spans


@pytest.fixture(scope="module")
def names():
    return pii.Pseudonyms(b"key")


LEAKS = [
    "BE68 5390 0754 7034 NOW", "BE68539007547034 NOW", "4111111111111111 2 items", "4111 1111 1111 1111 99", "99 4111111111111111 x",
    "pay GB82 WEST 1234 5698 7654 32 OK and DE89370400440532013000.", "12 4111 1111 1111 1111 12", "NO93 8601 1117 947 9",
]


@pytest.mark.parametrize("text", LEAKS)
def test_valid_values_followed_by_more_are_replaced(names, text):
    new, spans = names.apply(text)
    assert detect(text), "the detector finds them"
    for a, b in detect(text):
        assert any(s <= a and b <= e or a <= s < b or a < e <= b for _, s, e in spans)
    kinds = [kind for kind, _, _ in spans]
    assert "iban" in kinds or "card" in kinds
    for _, a, b in spans:
        assert text[a:b] not in new
    assert len(new) == len(text) and detect(new)
    assert names.apply(new, back=True)[0] == text


def test_no_value_of_the_corpus_stays_in_clear(names):
    found = 0
    for r in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        text = r["text"] or ""
        values = [(a, b) for a, b in detect(text)]
        _, spans = names.apply(text)
        for a, b in values:
            found += 1
            assert any(s < b and a < e for _, s, e in spans), text[a:b]
    assert found >= 5


def test_clean_text_stays(names):
    for text in ("Item 1234 of 5678, 12 34 56", "BE00 0000 0000 0000 is no IBAN", "4111111111111112 fails", "AB12 words follow", "1 2 3 4 5 6 7 8 9 0 1"):
        assert names.apply(text) == (text, [])


def test_short_months(names):
    text = "born 14 Mar 2015, Mar 14, 2015, Sept. no, 2 Dec. 1999 and 31 May 2001"
    new, spans = names.apply(text)
    assert [k for k, _, _ in spans] == ["date"] * 4 and names.apply(new, back=True)[0] == text
    first, second = (text[a:b] for _, a, b in spans[:2])
    assert (first, second) == ("14 Mar 2015", "Mar 14, 2015")
    moved = names.feistel.permute((date(2015, 3, 14) - date(1900, 1, 1)).days, (date(2099, 12, 31) - date(1900, 1, 1)).days + 1, "date")
    assert date(1900, 1, 1).toordinal() + moved in range(date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal())


def test_time_is_linear_in_the_text():
    def seconds(n):
        text = " ".join(f"2015-03-{k % 28 + 1:02d}" for k in range(n))
        fresh = pii.Pseudonyms(b"k")
        fresh.apply(text)  # values are known
        t = time.process_time()
        assert len(fresh.apply(text)[1]) == n
        return time.process_time() - t

    small, large = seconds(4000), seconds(32_000)
    assert large < 20 * small + 0.2


def test_bytes_that_are_not_utf8_and_wide_ids(spark):
    low, high = -(2**63), 2**63 - 1
    docs = spark.createDataFrame([(low, b"caf\xe9 \xff 4111111111111111"), (0, b"plain text of some length here"), (high, b"\xf0\x9f last one")], "doc_id long, raw binary")
    docs = docs.select("doc_id", F.col("raw").cast("string").alias("text"))
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, b"k").collect()}
    assert got[low]["n_card"] == 1 and got[low]["text"].startswith("caf� � ") and got[0]["text"] == "plain text of some length here"
    rows = {r["doc_id"]: r for r in fingerprint.edit_neighbours(docs).collect()}
    assert set(rows) == {low, 0, high} and rows[0]["n_chars"] == 30


def test_language_sample_is_bounded_and_deterministic(spark):
    """A cut-off of the hash comes before the window; an id with several texts always gives the same one."""
    p = language.Params(per_language=20)
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang"))
    again = many.union(many).union(spark.range(3).select(F.lit(7).cast("long").alias("doc_id"), F.lit("fr").alias("lang")))
    picked = language._smallest_hashes(again, p)
    rows = [(r["doc_id"], r["lang"]) for r in picked.collect()]
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(p.seed)), 11)
    for lang in ("en", "de"):
        want = {r["doc_id"] for r in many.where(F.col("lang") == lang).orderBy(unit, "doc_id").limit(20).collect()}
        assert {i for i, name in rows if name == lang} == want
    assert (7, "fr") in rows and len(rows) == 41
    texts = [(k // 4, f"{'the cat sat on a mat' if k % 2 else 'der Hund lief im Wald'} {k}", "en" if k % 2 else "de") for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    one, two = (language.fit(docs.repartition(n)) for n in (2, 7))
    assert all((one.pair_weights[k] == two.pair_weights[k]).all() for k in one.pair_weights)
