"""Language ID against a plain naive Bayes, and its held-out accuracy."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlake.llm import language_id
from scoutlake.llm.language_id import Grams, letter_bits
from scoutlake.llm.queries import op11_language_id

SF = "/root/testdata/sf0.01"
ROWS = [
    (0, "the cat and the dog", "en"), (1, "der Hund und die Katze", "de"), (2, "Le chien, et le chat!", "fr"), (3, "the the", "en"),
    (3, "the the", "en"), (4, None, "de"), (5, "", "fr"), (6, "12 +++ 34", "en"), (None, "das Haus", "de"), (7, "ein Haus", None),
    (8, "ÉCOLE Straße 你好 мир", "fr"), (9, "x" * 300_000 + " und", "de"), (10, " the\n\ncat", "en"),
]


def held_out(key):
    return zlib.crc32(str("" if key is None else key).encode()) % 4 == 2


def plain_grams(text):
    """(size, characters) of every n-gram, with one border for each run of other characters."""
    stream = [""]
    for c in (text or "").lower():
        if c.isalpha():
            stream.append(c)
        elif stream[-1]:
            stream.append("")
    if stream == [""]:
        return []
    stream += [""] if stream[-1] else []
    return [tuple(stream[i : i + n]) for n in range(1, language_id.LONGEST + 1) for i in range(len(stream) - n + 1)]


def slot_of(gram):
    mixed = 0
    for size, c in enumerate(gram, 1):
        mixed = (mixed * 2_654_435_761 + (ord(c) if c else 0) + size) % 2**32
    return ((mixed ^ (mixed >> 15)) * 2_246_822_519 % 2**32) >> 17


def test_slots_are_those_of_the_n_grams(monkeypatch):
    grams = Grams(letter_bits())
    for piece in (1 << 18, 5):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for text in ("", "1", "a", " Ab, cÉ d1e ", "你好 мир"):
            found = [s for part in grams.slots(text) for s in part.tolist()]
            assert sorted(found) == sorted(map(slot_of, plain_grams(text)))


def test_prediction_equals_plain_bayes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)
    learn = [r for r in ROWS if r[2] is not None and not held_out(r[0])]
    share, counts = collections.Counter(r[2] for r in learn), collections.defaultdict(collections.Counter)
    for _, text, lang in learn:
        counts[lang].update(map(slot_of, plain_grams(text)))
    clash = docs.withColumns({"score": F.lit("taken"), "lang_pred": F.lit(1), "label": F.lit("x")})
    rows = language_id.predict(clash, language_id.fit(clash)).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        seen = [slot_of(g) for g in plain_grams(row.text)]
        logs = {
            lang: math.log(n / len(learn)) + math.fsum(
                math.log((counts[lang][s] + 0.5) / (counts[lang].total() + 0.5 * language_id.SLOTS)) for s in seen)
            for lang, n in sorted(share.items())
        }
        best = max(logs, key=logs.get)
        expected = ("und", 0.0) if not seen else (best, 1 / sum(math.exp(max(x - logs[best], -700)) for x in logs.values()))
        assert row.lang_pred == expected[0] and row.score == pytest.approx(expected[1], abs=1e-6)


def test_without_documents_or_languages(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.fit(empty) is None and language_id.predict(empty, None).count() == 0
    unknown = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language_id.fit(unknown) is None
    assert [(r.lang_pred, r.score) for r in language_id.predict(unknown, None).collect()] == [("und", 0.0)]
    tied = spark.createDataFrame([(0, "ab", "b"), (1, "ab", "a")], "doc_id long, text string, lang string")
    assert not held_out(0) and not held_out(1)
    assert {r.lang_pred for r in language_id.predict(tied, language_id.fit(tied)).collect()} == {"a"}


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op11_language_id(spark, SF).join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.99
