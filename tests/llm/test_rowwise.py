"""Licence scan, quality, BPE, language, personal data: brute force, round trip, held-out accuracy and odd tables."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quern.llm import bpe, language_id, license_scan, pii, quality
from quern.llm.common import running_sums
from quern.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ODD

SF10 = "/root/testdata/sf0.01"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


ODD_IDS = sorted(str(r[0]) for r in ODD)


# op1

def test_license_base_against_brute_force(spark, docs10):
    got = {r.doc_id: r for r in QUERIES["op1_license_scan"](spark, SF10).collect()}
    for r in docs10.collect():
        w, places, labels = brute.words(r.text), [], set()
        for phrase, label in license_scan.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(w), len(places), min(places, default=None), max(places, default=None))
        assert g.base_labels == ",".join(sorted(labels)) and labels <= set(g.labels.split(",")) and 0 <= g.score <= 1


@pytest.mark.parametrize("text, licences, grade", [
    ("MIT OR GPL-2.0-only", {"mit", "gpl-2.0-only"}, 1.0),
    ("MIT AND GPL-2.0-only", {"mit", "gpl-2.0-only"}, 0.3),
    ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", {"gpl-2.0-only", "mit"}, 0.6),
    ("(MIT OR Apache-2.0) AND LGPL-3.0-or-later", {"mit", "apache-2.0", "lgpl-3.0-or-later"}, 0.6),
    ("MIT or AGPL-3.0 and GPL-3.0", {"mit", "agpl-3.0", "gpl-3.0"}, 1.0),
])
def test_license_expressions(text, licences, grade):
    assert license_scan.evaluate(license_scan.to_postfix(license_scan.expression_tokens(text))) == (licences, grade)


@pytest.mark.parametrize("text", ["", "OR MIT", "MIT AND", "(MIT", "MIT AND )", "AND", "()"])
def test_broken_license_expressions(text):
    assert license_scan.to_postfix(license_scan.expression_tokens(text)) is None


def test_license_tags_and_prose():
    n, hits, found, score = license_scan.scan_text(b"# SPDX-License-Identifier: (MIT OR Apache-2.0) */ and so on\nSPDX-License-Identifier:\nMIT License mit license")
    assert [f["licences"] for f in found] == [["apache-2.0", "mit"], ["spdx-invalid"]] and score > 0.9
    assert [h["word"] for h in hits if h["kind"] == "base"] == [14, 16] and n == 18


def test_license_odd(odd, empty):
    out = license_scan.summary(license_scan.scan(odd, keep=["doc_id"]))
    assert ids(out) == ODD_IDS and license_scan.summary(license_scan.scan(empty)).count() == 0
    assert license_scan.scan(odd).columns.count("hits") == 1


# op2

def test_quality_on_held_out_documents(spark):
    out = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF10).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF10}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for i, r in out.items())
    held = [(out[i].predicted, q) for i, q in labels.items() if i in out and out[i].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.95


def test_quality_doesnt_learn_from_held_out_labels(spark, docs10):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = spark.read.parquet(f"{SF10}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs10, x, usable=~held) for x in (labels, turned))
    assert abs(a.means[0] - b.means[0]).max() < 1e-9 and abs(a.factors[1] - b.factors[1]).max() < 1e-9


def test_quality_odd(spark, odd, empty, docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality.train(docs, labels)
    out = quality.score(odd, model)
    assert ids(out) == ODD_IDS and out.columns.count("score") == 1 and all(0 <= r.score <= 1 for r in out.collect())
    assert quality.score(empty, model).count() == 0
    assert quality.train(odd, labels.limit(0)).share == 0.5
    odd_labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (7, 1)], "doc_id long, quality int")
    assert quality.train(odd, odd_labels).share == 1.0  # only 7 has a label


# op3

def test_bpe_against_tiktoken(spark, docs):
    ranks = bpe.ranks_of(open(PATH, "rb").read())
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()}
    for r in docs.collect():
        found = own.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(found) and g.ids_sha256 == hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_bpe_odd_texts_against_tiktoken():
    data = open(PATH, "rb").read()
    codec = bpe.Codec(data, PATTERN)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["", " ", "a" * 5000, "!?" * 400, "xé" * 300, "it's 'S we'll \n 's", "\U0001F600" * 200]
    texts += ["".join(rng.choice(" \n\t\r\x0b\x1c\x85\xa0 ​ ab1'sé!.²٣") for _ in range(rng.randint(0, 16))) for _ in range(2000)]
    flat, counts = codec.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert flat[at:at + n].tolist() == own.encode_ordinary(text), repr(text)
        at += n


def test_bpe_round_trip_odd(odd, empty):
    out = bpe.decode(bpe.encode(odd, PATH, PATTERN), PATH)
    assert ids(out) == ODD_IDS
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in out.collect())
    assert bpe.encode(empty, PATH, PATTERN).count() == 0


def test_bpe_refuses_unknown_ids(spark):
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([([99_999_999],)], "ids array<int>"), PATH).collect()


# op6

def test_language_on_held_out_documents(spark, docs10):
    out = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, SF10).collect()}
    truth = {r.doc_id: r.lang for r in docs10.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    held = [(r.lang_pred, truth[i]) for i, r in out.items() if r.held_out and truth[i]]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_language_odd(odd, empty, docs):
    model = language_id.fit(docs)
    out = language_id.predict(odd, model)
    assert ids(out) == ODD_IDS
    for r in out.collect():
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or ""))
    assert language_id.predict(empty, model).count() == 0
    nothing = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}


def test_language_grams_against_sets():
    for text in (b"", b"a", b"Ab", b"a1!b", "é Straße, 12 ab ab".encode()):
        a = re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower())
        want = {a[i:i + n].ljust(4, b"\0") for n in range(1, 5) for i in range(len(a) - n + 1)}
        if not a.startswith(b" ") and not a.endswith(b" "):
            got = language_id.grams(text)
            assert len(got) == len(want) and {int(g).to_bytes(4, "big") for g in got} == want


def test_language_of_long_and_mixed_texts(spark):
    """Prose of 100 KB and 1 MB, and 100 KB with 50 KB of base64 behind it, keeps its language."""
    import base64

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    prose = {}
    for r in docs.orderBy("doc_id").collect():
        if r.lang and r.text and len(prose.get(r.lang, "")) < 1_000_000:
            prose[r.lang] = prose.get(r.lang, "") + r.text + "\n"
    noise = base64.b64encode(random.Random(5).randbytes(37_500)).decode()
    rows = []
    for lang, text in prose.items():
        rows += [(f"{lang} long", text[:1_000_000]), (f"{lang} 100", text[:100_000]), (f"{lang} mixed", text[:100_000] + "\n" + noise)]
    out = {r.id: r.lang_pred for r in language_id.predict(spark.createDataFrame(rows, "id string, text string"), model).collect()}
    assert {i: p for i, p in out.items() if i.split()[0] != p} == {}


# op7

def test_pii_against_brute_force(spark, docs):
    rng = random.Random(3)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "a@b.c", "a@b.c._x@d.e", "+1 (555) 123-4567", "000001.2.3.4"]
    signs = "0123456789.. -+()@ab_%c\n1é\U0001F600 "
    texts = ["".join(rng.choice(parts) if rng.random() < .2 else rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += [None, "", "a@b.cc " * 1500, "1.2.3." * 1500, "1 " * 9000, "4" * 40, "+1" + "(" * 20000]
    rows = list(enumerate(texts)) + [(10_000 + r.doc_id, r.text) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.summary(pii.find(df)).collect()}
    for i, text in rows:
        found = brute.personal(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        g = got[i]
        assert g.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), repr((text or "")[:200])
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == x for k, _, _ in found) for x in brute.PII]
        assert g.spans == listed or g.spans.startswith(listed)


def test_pii_runs_that_never_match_are_linear(spark):
    df = spark.createDataFrame([(1, "1" * 300_000), (2, "a" * 300_000 + "@"), (3, "1." * 150_000)], "doc_id long, text string")
    assert [r.spans.count("email") for r in pii.summary(pii.find(df)).collect()] == [0, 0, 0]


def test_pii_validators_and_context(spark):
    text = "iban DE89 3704 0044 0532 0130 00, GB82WEST12345698765432, DE88 3704 0044 0532 0130 00; order 4111 1111 1111 1111 card 4111 1111 1111 1111"
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.kind, text[s.start:s.end]) for s in found] == [
        ("card", "4111 1111 1111 1111"), ("card", "4111 1111 1111 1111"), ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert found[0].score < 0.8 < found[1].score
    clean = pii.redact(spark.createDataFrame([(1, "mail a@b.cc, call +1 (555) 123-4567"), (2, None)], "doc_id long, text string")).collect()
    assert [r.text for r in clean] == ["mail [email], call [phone]", None]


def test_pii_odd(odd, empty):
    out = pii.find(odd)
    assert ids(out) == ODD_IDS and out.columns.count("spans") == 1
    assert pii.summary(pii.find(empty)).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([([],), ([5],), (list(range(2000)),)], "x array<bigint>")
    got = [r[0] for r in df.select(running_sums(F.col("x"), 64)).collect()]
    assert got == [[sum(range(i)) for i in range(n)] if n > 1 else [0] * n for n in (0, 1, 2000)]
