"""License scan by diagonal voting.

Every text is cut into rolling word k-grams and hashed; those that any template has are
joined by Spark to the positions of the same k-grams in the templates. A match votes for its diagonal (position in the text
minus position in the template); neighbouring diagonals, which a word put in or left out
sets apart, are merged, and the words of the template that a merged group really covers
are counted: only groups with enough of them are verified.

Templates are few and short, whatever the corpus: their k-grams go to all tasks, after a
check of their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.llm.words import NOT_ALPHANUMERIC, grams, portions, word_hashes

# fixed values: phrases whose every place is reported, and their labels
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# notices of public licenses, in words, by the label they add
NOTICES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "apache": ["licensed under the apache license version 2 0"],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by": ["licensed under cc by 4 0"],
    "all-rights-reserved": ["all rights reserved"],
}
MOST_GRAMS = 100_000  # of all templates together, so that they may be broadcast
WORD_BITS = 60  # words of a template to one long value

_PLACE = ["row", "doc_id", "n_words", "template", "template_words", "label", "base"]


def _bits() -> Column:
    """Which of a part's words are covered."""
    return F.bit_or(F.expr(f"shiftleft(1L, word % {WORD_BITS})"))


def _labels(label: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


@dataclass(frozen=True)
class LicenseSettings:
    """``gram``: words of a k-gram; a shorter template is one k-gram of its own length."""

    gram: int = 4
    neighbours: int = 2  # diagonals this close are one place
    coverage: float = 0.8  # share of a template's words that a place has to cover


def _template_rows(phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]], gram: int):
    """(hash, size, template, at, words, label, base) for every k-gram of every template."""
    texts = [(text, label, True) for text, label in phrases.items()]
    texts += [(text, label, False) for label, many in notices.items() for text in many]
    rows = []
    for number, (text, label, base) in enumerate(texts):
        words, _ = word_hashes(pa.array([text]), NOT_ALPHANUMERIC)
        size = len(words) if base else min(gram, len(words))
        for at, value in enumerate(grams(words, size).view(np.int64).tolist()):
            rows.append((value, size, number, at, len(words), label, base))
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"templates have {len(rows)} k-grams; at most {MOST_GRAMS} are broadcast")
    return rows


_TEMPLATE = T.StructType(
    [
        T.StructField("value", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("template", T.IntegerType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("template_words", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("base", T.BooleanType()),
    ]
)


_HITS = "doc_id long, n_words long, hits array<struct<size: int, pos: int, value: long>>"


def _rolled(
    batches: Iterator[pa.RecordBatch], templates: Mapping[int, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, n_words, hits): a text's rolling hashes that any template has, by size.

    ``templates`` has the sorted hashes of each k-gram size. All others would meet nothing
    in the join. The first hit of a text is its marker, of size 0.
    """
    for batch in portions(batches):
        words, offsets = word_hashes(batch.column(1), NOT_ALPHANUMERIC)
        counts = np.diff(offsets)
        texts = np.arange(len(counts))
        row = np.repeat(texts, counts)
        zeros = np.zeros(len(texts), dtype=np.int64)
        rows, sizes, places, hashes = [texts], [zeros], [zeros], [zeros]
        for size, known in templates.items():
            values = grams(words, size).view(np.int64)
            nearest = np.minimum(np.searchsorted(known, values), len(known) - 1)
            at = np.flatnonzero(known[nearest] == values)
            at = at[at + size <= offsets[row[at] + 1]]  # the k-gram lies within one row
            rows.append(row[at])
            sizes.append(np.full(len(at), size))
            places.append(at - offsets[row[at]])
            hashes.append(values[at])
        row = np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))])
        hits = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(sizes)[order].astype(np.int32)),
                pa.array(np.concatenate(places)[order].astype(np.int32)),
                pa.array(np.concatenate(hashes)[order]),
            ],
            ["size", "pos", "value"],
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(counts.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), hits),
            ],
            ["doc_id", "n_words", "hits"],
        )


def scan(
    spark: SparkSession,
    documents: DataFrame,
    settings: LicenseSettings = LicenseSettings(),
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, Sequence[str]] = NOTICES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    One row for every row of documents, repeated rows and null ids included. ``spans``
    lists the verified places as (label, first, last, coverage), in words from 0. Score is
    the best coverage of a verified place, 0 without one; a phrase covers itself whole.
    A place's coverage is the share of its words, or of its template's if these are more,
    that are words of the template standing there, each counted once however many
    diagonals have it. Very long texts with very many places take time in proportion.
    Null and empty texts have no words, empty labels and null places. Other columns are
    not read. Words are runs of A-Z (lower-cased), a-z, 0-9 and bytes beyond ASCII.
    """
    rows = _template_rows(phrases, notices, settings.gram)
    hashes = {
        size: np.unique(np.array([row[0] for row in rows if row[1] == size], dtype=np.int64))
        for size in sorted({row[1] for row in rows})
    }
    # the entry of size 0 meets the one marker of each text, so that every text is returned
    marker = (0, 0, -1, 0, 1, "", False)
    templates = F.broadcast(spark.createDataFrame([marker, *rows], _TEMPLATE))
    votes = (
        documents.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
        )
        .mapInArrow(partial(_rolled, templates=hashes), _HITS)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "n_words", F.inline("hits"))
        .join(templates, ["value", "size"])
    )
    # a hit stands for the words it covers; those of one diagonal are bits, a few long values
    # for any number of hits, summed up before the shuffle
    covered = votes.withColumn("diagonal", F.col("pos") - F.col("at")).withColumn(
        "word", F.explode(F.sequence("at", F.col("at") + F.greatest("size", F.lit(1)) - 1))
    )
    diagonals = covered.groupBy(
        *_PLACE, "diagonal", (F.expr(f"word div {WORD_BITS}")).alias("part")
    ).agg(_bits().alias("bits"), F.min("pos").alias("first"), F.max(F.expr("pos + size - 1")).alias("last"))
    # from here on all of a text is in one task, sorted, never in one array
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    near = F.least(F.lit(settings.neighbours), F.col("template_words") - 1)
    apart = (step > near) | (F.col("base") & (step > 0))  # every place of a phrase counts
    places = (
        diagonals.repartition("row")
        .withColumn("begins", F.coalesce(apart, F.lit(True)).cast("long"))
        .withColumn("place", F.sum("begins").over(along))
        .groupBy(*_PLACE, "place", "part")
        .agg(
            F.bit_or("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last")
        )
        .groupBy(*_PLACE, "place")
        .agg(
            F.sum(F.bit_count("bits")).alias("covered"),
            F.min("first").cast("long").alias("first"), F.max("last").cast("long").alias("last"),
        )
        .withColumn(
            "coverage",
            F.col("covered") / F.greatest("template_words", F.col("last") - F.col("first") + 1),
        )
    )
    known = F.col("template") >= 0
    start = F.when(F.col("base"), F.col("first"))
    verified = known & (F.col("base") | (F.col("coverage") >= settings.coverage))
    span = F.when(verified, F.struct("label", "first", "last", "coverage"))
    # collecting leaves nulls out: what the marker and places that fail give
    return (
        places.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(start).alias("n_base"),
            F.min(start).alias("first_word"),
            F.max(start).alias("last_word"),
            _labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
            _labels(F.when(verified, F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(verified, F.col("coverage"))), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(span)).alias("spans"),
        )
        .drop("row")
    )
