"""Connected components of a table of links, on Spark: least labels of neighbours and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.tables import saved

#: Links that a task joins at once before any are shuffled.
CHUNK = 500_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the links a, b, and the least node that each of them reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while (apart := label[x] != label[y]).any():
        x, y = label[x[apart]], label[y[apart]]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((further := label[label]) != label).any():
            label = further
    return nodes, nodes[label]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node with the least one that it reaches by the links of its chunk: chains within a chunk have one step."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield _least(held)
            held, n = [], 0
    if n:
        yield _least(held)


def _least(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    chunk = pa.Table.from_batches(held)
    nodes, least = roots(chunk["a"].to_numpy(), chunk["b"].to_numpy())
    return pa.RecordBatch.from_pydict({"a": nodes, "b": least})


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of links (a, b), two longs, reaches; the rounds grow with the logarithm of the longest chain of chunks.

    An empty table of links gives an empty result; repeated links and loops change nothing.
    """
    near = saved(links.select("a", "b").mapInArrow(_joined, "a long, b long"), "links")
    both = near.union(near.where("a <> b").select("b", "a"))
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        step = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        jumped = saved(hooked.join(step, "to", "left").select("node", "old", F.least("to", "further").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
