"""Fill-in-middle transformation by block rotation inside one buffer.

A text is cut into lines, and two cuts drawn from a hash of its id make a prefix, a
middle and a suffix of whole lines. The three sentinels are inserted into a bytearray
that holds the text; the segments then change places by rotations, each of which is
three reversals of the same buffer. Restoring rotates back and takes the sentinels out.

The text holds no sentinel, and none can arise across a border, as a sentinel begins
with `<` and ends with `>` and has neither inside. So the sentinels of an output are
found by search, and output and form alone give the text back.

Nulls count as empty texts, whose form is `plain`; a null id is hashed as an empty
text. Repeated rows are transformed alike, and columns named like an added one are
replaced. Nothing is shuffled, so no key can be hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import bounded_batches, wider

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE = 64
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: str, key: str) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the SHA-256 of `seed:key`."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[at : at + 4], "big") for at in (0, 4, 8, 12))


def unit_ends(text: bytes) -> np.ndarray:
    """Byte offsets of the ends of the lines, with 0 in front; the last line may lack its break."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return np.concatenate(([0], ends))


def code_points(text: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def rotate(buffer: bytearray, start: int, border: int, end: int) -> None:
    """Exchanges `[start, border)` and `[border, end)` by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for low, high in ((start, border), (border, end), (start, end)):
        view[low:high] = view[low:high][::-1]


def arranged(text: bytes, first: int, second: int, form: str) -> bytes:
    """The output of a text that is cut at the two byte offsets."""
    buffer = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle, suffix = len(PREFIX) + first, len(PREFIX) + len(MIDDLE) + second
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text behind an output."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    if form == PSM:
        rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    else:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _binary(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "7", rate: int = 100, spm: int = 50
) -> DataFrame:
    """`docs` with n (lines), form, prefix_chars, middle_chars and output.

    Of a hundred texts, `rate` are rearranged on average, `spm` in a hundred of them with the
    suffix first. Empty texts and texts that hold a sentinel stay plain, with null lengths.
    """
    bounded_batches(docs.sparkSession)
    added = [field.split()[0] for field in ADDED.split(", ")]
    if {key, text} & set(added):
        raise ValueError(f"the id and the text cannot be called {added}")
    kept = docs.drop(*added)
    rows = kept.withColumn("_hash_key", F.coalesce(F.col(key).cast("string"), F.lit("")))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part, facts, outputs = batch.slice(start, SLICE), [], []
                for body, name in zip(_binary(part, text), part.column("_hash_key").to_pylist()):
                    ends = unit_ends(body)
                    n = len(ends) - 1
                    h1, h2, h3, h4 = draws(seed, name)
                    if not body or h3 % 100 >= rate or any(mark in body for mark in (PREFIX, SUFFIX, MIDDLE)):
                        facts.append({"n": n, "form": PLAIN})
                        outputs.append(body)
                        continue
                    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                    first, second = int(ends[low]), int(ends[high])
                    form = SPM if h4 % 100 < spm else PSM
                    facts.append({
                        "n": n, "form": form, "prefix_chars": code_points(body[:first]),
                        "middle_chars": code_points(body[first:second]),
                    })
                    outputs.append(arranged(body, first, second, form))
                found = pa.Table.from_pylist(facts, schema).combine_chunks()
                columns = [c for c, name in zip(part.columns, part.schema.names) if name != "_hash_key"]
                names = [name for name in part.schema.names if name != "_hash_key"]
                columns += [c.chunk(0) for c in found.columns] + [pa.array(outputs, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, *schema.names, "output"])

    return rows.mapInArrow(fill, wider(kept, ADDED))


def restore(rows: DataFrame, output: str = "output", form: str = "form", alias: str = "restored") -> DataFrame:
    """`rows` with the text behind each output; a null output gives an empty text."""
    bounded_batches(rows.sparkSession)
    rows = rows.drop(alias)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = [restored(o, f or PLAIN) for o, f in zip(_binary(part, output), part.column(form).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).view(pa.string())], [*part.schema.names, alias]
                )

    return rows.mapInArrow(back, wider(rows, f"`{alias}` string"))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), units AS (
  SELECT doc_id, body, regexp_extract_all(body, '[^\n]*\n|[^\n]+') AS lines,
         ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4
  FROM texts
), cuts AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS low,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1))::BIGINT AS high,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *, coalesce(array_to_string(list_slice(lines, 1, low), ''), '') AS p,
         coalesce(array_to_string(list_slice(lines, low + 1, high), ''), '') AS m,
         coalesce(array_to_string(list_slice(lines, high + 1, n), ''), '') AS s
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts"""
