"""Every candidate of the secret scan is scored: short strings, parts beside base spans, and planted credentials."""

import random

import pyarrow.parquet as pq

from sluice.llm import secret_scan
from tests.llm.conftest import prose

HEX, CAPS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def made(rnd, letters, n):
    return "".join(rnd.choice(letters) for _ in range(n))


def test_candidates_are_what_base_spans_leave():
    rnd = random.Random(1)
    inner = made(rnd, HEX, 40)
    texts = {
        "short a1b2c3d4 tiny x1": ["a1b2c3d4"],
        f"see PREFIX_LONGER-{inner}-suffix+more end": ["PREFIX_LONGER-", "-suffix+more"],
        f"SHORT-{inner}": [],
        f"{inner}/{inner}===========": ["==========="],
        "password=hunter2hunter2 then-plain-words": ["then-plain-words"],
        "": [],
    }
    for text, expected in texts.items():
        base, _ = secret_scan.base_spans(text)
        assert [text[a:b] for a, b in secret_scan.candidates(text, base)] == expected


def test_many_base_spans_take_linear_time():
    rnd = random.Random(2)
    text = " ".join(f"token={made(rnd, HEX, 12)} {made(rnd, CAPS, 12)}" for _ in range(20000))
    base, _ = secret_scan.base_spans(text)
    assert len(base) == 20000 and sum(1 for _ in secret_scan.candidates(text, base)) == 20000


def test_planted_credentials_of_held_out_forms_are_found(spark):
    """Real texts with credentials that no base pattern finds, of forms like the labelled ones: most are added, and little else."""
    rnd = random.Random(3)
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist() if t]
    keys = [f"key AKIA{made(rnd, CAPS, 16)} and {made(rnd, HEX, 40)}" for _ in range(300)]
    forms = {"key": lambda: "ASIA" + made(rnd, CAPS, 16), "hex": lambda: made(rnd, HEX, 28)}
    planted = []
    for i, text in enumerate(texts):
        words = text.split(" ")
        form = list(forms)[i % 2]
        secret = forms[form]()
        words.insert(rnd.randrange(len(words) + 1), secret)
        planted.append((i, " ".join(words), form, secret))
    schema = "doc_id bigint, text string"
    before = spark.createDataFrame([*enumerate(texts), *[(-1 - i, k) for i, k in enumerate(keys)]], schema)
    frame = spark.createDataFrame([p[:2] for p in planted], schema)
    found = secret_scan.scan(frame, secret_scan.sample_credentials(before), name="out").select("doc_id", "text", "out.added")
    added = {r.doc_id: [r.text[s.start : s.end] for s in r.added] for r in found.collect()}
    for form in forms:
        of_form = [(i, secret) for i, _, f, secret in planted if f == form]
        assert sum(any(secret in a for a in added[i]) for i, secret in of_form) >= 0.9 * len(of_form), form
    beside = sum(secret not in a for i, _, _, secret in planted for a in added[i])
    assert beside <= 0.01 * len(planted)


def test_plain_texts_gain_nothing(spark):
    rnd = random.Random(4)
    rows = [(i, prose(rnd, 200) + f" token={made(rnd, HEX, 32)}" + " Word.word-word https://a.example/path/page.html 2027-11-08T08:00:00") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = secret_scan.scan(frame, secret_scan.sample_credentials(frame), name="out")
    assert out.filter("size(out.added) > 0").count() == 0
