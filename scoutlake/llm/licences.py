"""Licence scan by a positional index of rare licence words, in DataFrame functions only.

1. A text's words that occur in any template are its postings, with positions.
2. Inverse document frequencies of the template words are counted over all texts.
3. A template's anchor is the word of highest IDF in its mandatory key phrase, whatever
   that is: no word is too frequent to serve. Templates are indexed by their anchors.
   Every posting of an anchor is a candidate: the place at which the template would start.
4. Around a candidate the postings are intersected with those of the template by relative
   position. The template is found if its whole key phrase stands in place; as the anchor is
   a word of that phrase, no place of a key phrase goes without a candidate. The score is the
   largest IDF share of a template's words that stand in place, from 0 (no licence) to 1 (a
   whole template). Postings further off than a template is long are not looked at, so the
   work grows with the candidates, and nothing leaves the row.

Base phrases give labels of their own and are counted at all their places by a plain search.
Null texts are empty. Repeated rows are scanned each for itself; other columns are dropped.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Label, mandatory key phrase, and the words of the notice around it.
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu gpl", "licensed under the gnu gpl"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license"),
    ("bsd", "bsd license", "licensed under the bsd license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("isc", "isc license", "licensed under the isc license"),
    ("unlicense", "released into the public domain", "free and unencumbered software released into the public domain"),
    ("cc-by", "cc by 4", "licensed under cc by 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("reserved", "all rights reserved", "copyright all rights reserved"),
)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def postings(docs: DataFrame, vocabulary: Sequence[str], id_col: str, text: str) -> DataFrame:
    """(uid, id, n_words, hits): words are counted whole, hits are (word, at) of the vocabulary."""
    low = "abcdefghijklmnopqrstuvwxyz"
    known = sorted(vocabulary)

    def hits(words: Column) -> Column:
        # Only words of the vocabulary are lowered letter by letter; `lower` alone would also change other letters.
        placed = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
        kept = F.filter(placed, lambda p: F.lower(p["word"]).isin(known))
        lowered = F.transform(kept, lambda p: F.struct(F.translate(p["word"], low.upper(), low).alias("word"), p["at"].alias("at")))
        return F.struct(F.size(words).cast("long").alias("n"), F.filter(lowered, lambda p: p["word"].isin(known)).alias("hits"))

    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))
    found = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col), _let(words, hits).alias("f"))
    return found.select("uid", id_col, F.col("f.n").alias("n_words"), F.col("f.hits").alias("hits"))


def starts(hits: Column, phrase: str) -> Column:
    """Sorted positions at which the words of a phrase stand consecutively."""

    def places(i: int, word: str) -> Column:
        return F.transform(F.filter(hits, lambda p: p["word"] == word), lambda p: p["at"] - i)

    return F.array_sort(functools.reduce(F.array_intersect, (places(i, w) for i, w in enumerate(phrase.split()))))


def _entries(phrase: str, body: str) -> list[tuple[int, str, bool, bool]]:
    """(place, word, of the notice, of the key phrase) of a template."""
    noted = set(enumerate(body.split()))
    keyed = {(_offset(phrase, body) + i, w) for i, w in enumerate(phrase.split())}
    return [(i, w, (i, w) in noted, (i, w) in keyed) for i, w in sorted(noted | keyed)]


def _offset(phrase: str, body: str) -> int:
    """Place of the key phrase in its notice; 0 if it does not stand there."""
    words, key = body.split(), phrase.split()
    return next((i for i in range(len(words)) if words[i : i + len(key)] == key), 0)


def word_weights(found: DataFrame) -> DataFrame:
    """(word, idf) of the vocabulary over all texts; as many rows as the vocabulary has words."""
    total = found.agg(F.count("*").alias("n"))
    words = found.select(F.explode(F.array_distinct(F.col("hits.word"))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("df"))
    return counted.select("word", F.log((total.scalar() + 1.0) / F.col("df") + 1.0).alias("idf"))


def _pick(templates: Sequence[tuple[str, str, str]], idf: Mapping[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Anchor word -> (template, place of the anchor): the index of the templates."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, (_, phrase, body) in enumerate(templates):
        keyed = [(place, word) for place, word, _, key in _entries(phrase, body) if key]
        place, word = max(keyed, key=lambda e: (idf.get(e[1], 0.0), -e[0]))
        index.setdefault(word, []).append((number, place))
    return index


def _candidate(around: Column, at: Column, number: int, anchor: int, template: tuple[str, str, str], idf: Mapping[str, float]) -> Column:
    """(template, start, label, share, found) of a template whose anchor is the posting at `at`."""
    label, phrase, body = template
    entries = _entries(phrase, body)
    # Whole billionths, so sums are exact in any order.
    weights = [round(idf.get(word, 0.0) * 1e9) if noted else 0 for _, word, noted, _ in entries]
    listed = F.array(*(
        F.struct(F.lit(place).alias("place"), F.lit(word).alias("word"), F.lit(weight).cast("long").alias("weight"), F.lit(key).alias("key"))
        for (place, word, _, key), weight in zip(entries, weights)
    ))
    start, whole = at - anchor, sum(weights)
    standing = F.filter(listed, lambda e: F.exists(around, lambda p: (p["at"] == start + e["place"]) & (p["word"] == e["word"])))

    def judged(stands: Column) -> Column:
        weight = F.aggregate(stands, F.lit(0).cast("long"), lambda total, e: total + e["weight"])
        return F.struct(
            F.lit(number).alias("template"),
            (start + _offset(phrase, body)).alias("start"),
            F.lit(label).alias("label"),
            (weight / whole if whole else F.lit(0.0)).alias("share"),
            (F.size(F.filter(stands, lambda e: e["key"])) == sum(key for *_, key in entries)).alias("found"),
        )

    return _let(standing, judged)


def template_matches(hits: Column, templates: Sequence[tuple[str, str, str]], idf: Mapping[str, float]) -> Column:
    """(label, start, share) of every place at which a template's key phrase stands, by template, then start."""
    index = _pick(templates, idf)
    reach = max(place for _, phrase, body in templates for place, *_ in _entries(phrase, body)) + 1

    def of_posting(posting: Column, i: Column) -> Column:
        first = F.greatest(i + 1 - reach, F.lit(1))

        def compared(around: Column) -> Column:
            found = None
            for word, owners in index.items():
                listed = F.array(*(_candidate(around, posting["at"], t, place, templates[t], idf) for t, place in owners))
                hit = posting["word"] == word
                found = F.when(hit, listed) if found is None else found.when(hit, listed)
            return F.filter(found, lambda c: c["found"])

        return F.when(posting["word"].isin(list(index)), _let(F.slice(hits, first, i + 1 + reach - first + 1), compared))

    judged = F.transform(hits, of_posting)
    found = F.array_sort(F.flatten(F.filter(judged, lambda m: F.size(m) > 0)))
    return F.transform(found, lambda m: F.struct(m["label"].alias("label"), m["start"].alias("start"), m["share"].alias("share")))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str, str]] = TEMPLATES,
    base: Mapping[str, str] = BASE,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches), one row per input row."""
    vocabulary = {w for _, _, body in templates for w in body.split()} | {w for p in base for w in p.split()}
    vocabulary |= {w for _, phrase, _ in templates for w in phrase.split()}
    found = stored(postings(docs, vocabulary, id_col, text), "postings")
    # One row for each word of the templates, however many texts there are.
    idf = {row.word: row.idf for row in word_weights(found).collect()}
    base_starts = {phrase: starts(F.col("hits"), phrase) for phrase in base}
    rows = found.select(
        id_col, "n_words",
        F.array(*(F.struct(F.lit(label).alias("label"), base_starts[p].alias("at")) for p, label in base.items())).alias("found"),
        template_matches(F.col("hits"), templates, idf).alias("matches"),
    )
    places = F.flatten(F.col("found.at"))
    based = F.filter("found", lambda f: F.size(f["at"]) > 0)
    rows = rows.withColumns({"places": places, "base": F.array_sort(F.array_distinct(F.transform(based, lambda f: f["label"])))})
    labels = F.array_sort(F.array_distinct(F.concat("base", F.col("matches.label"))))
    return rows.select(
        id_col,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(F.array_max(F.col("matches.share")), F.lit(0.0)).alias("score"),
        "matches",
    )

