"""Structure letters from residue vectors by a head of two convolutions along the sequence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of a weight table at most; it is read by the driver and sent to the tasks.
MOST_WEIGHTS = 4_000_000


def layers(weights: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """(kernel[place, input, output], bias[output]) of each layer from rows (layer, place, input, output, value); a bias has no place."""
    rows = weights.select("layer", "place", "input", "output", "value").limit(MOST_WEIGHTS + 1).collect()
    if len(rows) > MOST_WEIGHTS:
        raise ValueError(f"more than {MOST_WEIGHTS} weights")
    out = []
    for n in sorted({r.layer for r in rows}):
        own = [r for r in rows if r.layer == n]
        size = [1 + max((r[c] for r in own if r[c] is not None), default=0) for c in ("place", "input", "output")]
        kernel, bias = np.zeros(size), np.zeros(size[2])
        for r in own:
            if r.place is None:
                bias[r.output] = r.value
            else:
                kernel[r.place, r.input, r.output] = r.value
        if size[0] % 2 == 0:
            raise ValueError(f"layer {n} has {size[0]} places; an odd number is needed")
        out.append((kernel, bias))
    for (a, _), (b, _) in zip(out, out[1:]):
        if a.shape[2] != b.shape[1]:
            raise ValueError(f"a layer gives {a.shape[2]} numbers, the next takes {b.shape[1]}")
    return out


def convolved(x: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Sums over the places around each row; rows beyond both ends are zero."""
    half = len(kernel) // 2
    padded = np.pad(x, ((half, half), (0, 0)))
    return bias + sum(padded[k : k + len(x)] @ w for k, w in enumerate(kernel))


def structure_letters(df: DataFrame, key: str, matrix: str, weights: DataFrame, alphabet: str) -> DataFrame:
    """(key, letters): for each row of a matrix the letter whose output is largest, of equals the first.

    Negative numbers between layers become zero. A NULL matrix, or one of another width, has NULL letters; an empty one
    an empty text. Each row of the table is handled on its own, so nothing is shuffled.
    """
    net = layers(weights)
    if not net or net[-1][0].shape[2] != len(alphabet):
        raise ValueError(f"the last layer must give a number for each of {len(alphabet)} letters")
    sent = df.sparkSession.sparkContext.broadcast(net)
    width = net[0][0].shape[1]

    def read(rows: list[list[float]] | None) -> str | None:
        if rows is None or any(r is None or len(r) != width for r in rows):
            return None
        x = np.array(rows, float).reshape(len(rows), width)
        for k, (kernel, bias) in enumerate(sent.value):
            x = convolved(np.maximum(x, 0) if k else x, kernel, bias)
        return "".join(alphabet[i] for i in x.argmax(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 50):
                part = batch.slice(k, 50)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(read, part.column(1).to_pylist()), pa.string())], names=[key, "letters"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, matrix).mapInArrow(run, f"`{key}` {kind}, letters string")
