"""Token counts of the sections of documents, from one encoding of the whole text.

Sections are the lines of a text, each with its line feed. A text is encoded whole;
the spans of its tokens are joined to the spans of its sections. A token belongs to
the section that holds its first byte; a token that ends in a later section is
counted as crossing there where it starts. So the counts add up to the whole text's.

Null and empty texts have one empty section without tokens. Repeated rows are
counted each for itself; other columns than the id are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.byte_bpe import encode_documents


def section_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, section, start, end, n_tokens, n_crossing): spans in characters, sections counted from 0."""
    encoded = encode_documents(docs.select(id_col, F.col(text).alias("text")), ranks, pattern)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = ("start", "end", "n_tokens", "n_crossing")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(max(shared.value.values()) + 1, np.int64)
        for token, rank in shared.value.items():
            sizes[rank] = len(token)
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                raw = np.frombuffer((batch.column("text")[row].as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                ends = np.cumsum(sizes[batch.column("ids")[row].values.to_numpy()])
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
                breaks = np.flatnonzero(raw == 10) + 1
                borders = np.unique(np.concatenate([[0], breaks, [len(raw)]]))
                borders = borders if len(borders) > 1 else np.array([0, 0])
                owner = np.searchsorted(borders[:-1], starts, "right") - 1
                tokens = np.bincount(owner, minlength=len(borders) - 1)
                crossing = np.bincount(owner[ends > borders[owner + 1]], minlength=len(borders) - 1)
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[borders]
                table = zip(chars[:-1].tolist(), chars[1:].tolist(), tokens.tolist(), crossing.tolist())
                rows.append([dict(zip(names, x)) for x in table])
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(rows, kind)], [id_col, "sections"])

    struct = ", ".join(f"{name}: long" for name in names)
    found = encoded.mapInArrow(attribute, f"`{id_col}` {dict(encoded.dtypes)[id_col]}, sections array<struct<{struct}>>")
    return found.select(id_col, F.posexplode("sections").alias("section", "s")).select(id_col, "section", "s.*")
