"""Texts and word rules shared by these tests."""

import random
import re

from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    pool = "alpha beta gamma delta omega sun moon star".split()
    return " ".join(pick.choice(pool) + str(pick.randint(0, 400)) for _ in range(words))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def table_of(spark, folder, name, rows, schema, clashing=()):
    """A folder that holds one table of these rows, with extra columns of these names."""
    frame = spark.createDataFrame(rows, schema)
    for extra in clashing:
        frame = frame.withColumn(extra, F.lit("x"))
    frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
