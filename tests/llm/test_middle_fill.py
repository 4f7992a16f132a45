"""Fill-in-middle against string slices, and the exact way back."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from scoutlake.llm import middle_fill
from scoutlake.llm.queries import op12_fill_in_middle

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "é\n你好\r\n🙂\n", "has <P> inside\nx", "<S", "P>\n<\nM>", "x<M>", "<<P\n>\n<S\n>",
    "line\n" * 5_000 + "end",
]


def plain(key, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transform_and_restore(spark):
    rows = [(i * 100 + k, t) for i in range(8) for k, t in enumerate(TEXTS)] + [(None, "a\nb\nc"), (1, "a"), (1, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = docs.withColumns({"output": F.lit(1), "n": F.lit("x"), "restored": F.lit(2), "seed": F.lit("s")})
    found = middle_fill.restore(middle_fill.transform(clash)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.restored == (r.text or "") and r.seed == "s"
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_rotation():
    buffer = bytearray(b"xxABCdeyy")
    middle_fill.rotate(buffer, 2, 5, 7)
    assert buffer == b"xxdeABCyy"


def test_rate_and_names(spark):
    docs = spark.createDataFrame([(i, "a\nb") for i in range(400)], "doc_id long, text string")
    forms = [r.form for r in middle_fill.transform(docs, rate=30).collect()]
    assert 200 < forms.count("plain") < 340
    with pytest.raises(ValueError):
        middle_fill.transform(docs.withColumnRenamed("text", "output"), text="output")
    assert middle_fill.restore(middle_fill.transform(docs.limit(0))).count() == 0


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = op12_fill_in_middle(spark, SF)
    expected = con.sql(middle_fill.ORACLE)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, expected.fetchall()))
