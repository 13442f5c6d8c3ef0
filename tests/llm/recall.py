"""Recall of operators 3 and 4 on 50,000 planted rows, every pair exactly at the threshold.

``python -m tests.llm.recall``. Unrelated rows are far apart, so the planted pairs are all there are.
"""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark.sql import SparkSession

from daybook.llm import embeddings, minhash
from daybook.llm.common import ship
from daybook.session import RECOMMENDED_CONF

PAIRS = 25_000


def vectors(dim: int = 64) -> list[tuple[int, list[float]]]:
    """Pairs (i, i + PAIRS) of cosine 0.95, a hair above so that rounding loses none."""
    rng = np.random.default_rng(11)
    cosine = 0.95 + 1e-12
    u = rng.standard_normal((PAIRS, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.standard_normal((PAIRS, dim))
    w -= np.einsum("ij,ij->i", u, w)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    v = cosine * u + math.sqrt(1 - cosine * cosine) * w
    return list(enumerate(np.concatenate([u, v]).tolist()))


def documents(shingles: int = 90) -> list[tuple[int, str]]:
    """Pairs (i, i + PAIRS) that share 80 of 100 five-word shingles: another last ninth."""
    def words(i: int, version: int) -> str:
        n, last = shingles + 4, shingles // 9
        return " ".join(f"w{i}x{k}" if k < n - last else f"v{version}y{i}x{k}" for k in range(n))

    return [(v * PAIRS + i, words(i, v)) for v in (0, 1) for i in range(PAIRS)]


def main(which: list[str]) -> None:
    builder = SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
    for key, value in {**RECOMMENDED_CONF, "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "16"}.items():
        builder = builder.config(key, value)
    spark = ship(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if "op3" in which:
        frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>").repartition(16)
        rows = embeddings.near_duplicates(frame).toPandas()
        found = int((rows["component_id"] + PAIRS == rows["vec_id"]).sum())
        print("op3", found, "of", PAIRS, "links in all:", int(rows["n_links"].sum()) // 2, flush=True)
    if "op4" in which:
        frame = spark.createDataFrame(documents(), "doc_id long, text string").repartition(16)
        rows = minhash.near_duplicates(frame).toPandas()
        print("op4", rows.columns.tolist(), flush=True)
        found = int((rows["class_id"] + PAIRS == rows["doc_id"]).sum())
        print("op4", found, "of", PAIRS, flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or ["op3", "op4"])
