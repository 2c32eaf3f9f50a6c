"""Word vectors from counts: shifted positive mutual information, factored by randomised range finding.

Unlike trained vectors these do not depend on how the rows are partitioned: what is summed over rows are whole
numbers (counts, or values times a power of two), and the small dense steps between the passes
run on matrices of as many rows as dimensions.  The random projection is a hash of the word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.layout import written

WINDOW = 5
DIMENSIONS = 16
MORE = 8
ROUNDS = 2
#: Fixed-point places, in bits, of information values and of the basis.  A product of the two leaves room for the sum of
#: 2**19 words next to one; a sum beyond 64 bits raises an error.
INFO_BITS = 16
BASIS_BITS = 24
#: So many rows' products are added up in 64 bits before they become decimals.
GRAM_ROWS = 1 << 14


def word_pairs(docs: DataFrame, words: str, window: int = WINDOW) -> DataFrame:
    """Words ``a`` and ``b`` at most ``window`` places apart, both ways round, with their number ``n``."""
    size = F.size(words)

    def apart(step: Column) -> Column:
        length = F.greatest(size - step, F.lit(0))
        return F.arrays_zip(F.slice(words, 1, length).alias("a"), F.slice(words, step + 1, length).alias("b"))

    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window)), apart))
    forward = docs.where(size > 1).select(F.inline(pairs).alias("a", "b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    both = forward.unionAll(forward.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    return both.groupBy("a", "b").agg(F.sum("n").alias("n"))


def shifted_information(pairs: DataFrame, *, least: int = 1, shift: float = 1.0) -> DataFrame:
    """Pairs seen ``least`` times with their positive information ``ln(n N / (n_a n_b)) - ln(shift)``."""
    kept = pairs.where(F.col("n") >= least)
    sums = kept.groupBy("a").agg(F.sum("n").alias("n_a"))
    total = sums.agg(F.sum("n_a")).scalar().cast("double")
    joined = kept.join(sums, "a").join(sums.select(F.col("a").alias("b"), F.col("n_a").alias("n_b")), "b")
    value = F.log(F.col("n") / F.col("n_a") * (total / F.col("n_b"))) - F.lit(math.log(shift))
    return joined.select("a", "b", "n", value.alias("information")).where("information > 0")


def _fixed(value: Column, bits: int) -> Column:
    return F.round(value * F.lit(float(1 << bits))).cast("long")


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _gram(rows: DataFrame, left: str, right: str, width: int) -> np.ndarray:
    """Sums of products of two arrays of whole numbers below 2**24 over all rows, exactly, as doubles (width by width)."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GRAM_ROWS):
                block = batch.slice(at, GRAM_ROWS)
                cells = _matrix(block.column(left), width).T @ _matrix(block.column(right), width)
                yield pa.record_batch([pa.array(np.arange(width * width)), pa.array(cells.reshape(-1))], names=["cell", "s"])

    sums = rows.select(left, right).mapInArrow(products, "cell bigint, s bigint") if left != right else rows.select(left).mapInArrow(products, "cell bigint, s bigint")
    found = sums.groupBy("cell").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # width squared numbers
    gram = np.zeros(width * width)
    for row in found:
        gram[row["cell"]] = float(row["s"])
    return gram.reshape(width, width)


def _turned(basis: DataFrame, matrix: np.ndarray, fixed_bits: int | None) -> DataFrame:
    """The rows' arrays times a small matrix, always added in the same order; as fixed-point numbers, or as they are."""
    width, kind = matrix.shape[0], "double" if fixed_bits is None else "bigint"

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("v"), width).astype(float)
            total = np.zeros((len(values), matrix.shape[1]))
            for k in range(width):
                total += values[:, k : k + 1] * matrix[k]
            if fixed_bits is not None:
                total = np.rint(total * float(1 << fixed_bits)).astype(np.int64)
            offsets = pa.array(np.arange(0, total.size + 1, matrix.shape[1]), pa.int32())
            yield pa.record_batch([batch.column("word"), pa.ListArray.from_arrays(offsets, pa.array(total.reshape(-1)))], names=["word", "v"])

    return basis.mapInArrow(turn, f"word string, v array<{kind}>")


def _narrowed(basis: DataFrame) -> DataFrame:
    """All numbers divided by one power of two so that they stay below 2**24: the span is the same."""
    largest = basis.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0] or 0
    shift = max(0, int(largest).bit_length() - 24)
    return basis.select("word", F.transform("v", lambda x: F.shiftright(x, shift)).alias("v"))


def factor_vectors(information: DataFrame, *, dimensions: int = DIMENSIONS, more: int = MORE, rounds: int = ROUNDS) -> DataFrame:
    """Column ``word`` and ``vector``, from the largest eigenvalues of the matrix of ``a``, ``b`` and ``information``.

    A random projection finds the range, ``rounds`` products with the matrix sharpen it, and a small
    eigenproblem within the range gives the vectors.  Every product is one join and one aggregate.
    """
    width = dimensions + more
    values = written(information.select("a", "b", _fixed(F.col("information"), INFO_BITS).alias("m")), "information")
    # Signs from the bits of a hash of the word: the same for every row and run.
    signs = [F.when(F.shiftright(F.xxhash64("b", F.lit(j // 32)), j % 32).bitwiseAND(F.lit(1)) == 1, F.col("m")).otherwise(-F.col("m")) for j in range(width)]
    start = values.groupBy(F.col("a").alias("word")).agg(*[F.sum(s).alias(f"v{j}") for j, s in enumerate(signs)])
    basis = written(start.select("word", F.array(*[f"v{j}" for j in range(width)]).alias("v")), "basis")
    for _ in range(rounds):
        basis = written(_product(values, _orthonormal(basis, width), width), "basis")
    basis = _orthonormal(basis, width)
    image = written(_product(values, basis, width), "image")
    largest = image.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0] or 0
    shift = max(0, int(largest).bit_length() - 24)
    both = basis.join(image.select("word", F.transform("v", lambda x: F.shiftright(x, shift)).alias("z")), "word")
    inner = _gram(both, "v", "z", width) * 2.0 ** (shift - 2 * BASIS_BITS - INFO_BITS)
    eigen, turn = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-eigen)[:dimensions]
    scaled = turn[:, best] * np.sqrt(np.maximum(eigen[best], 0)) / float(1 << BASIS_BITS)
    return _turned(basis, scaled, None).withColumnRenamed("v", "vector")


def _product(values: DataFrame, basis: DataFrame, width: int) -> DataFrame:
    """The matrix times the basis, exactly in whole numbers."""
    joined = values.join(basis.withColumnRenamed("word", "b"), "b")
    product = joined.groupBy(F.col("a").alias("word")).agg(*[F.sum(F.col("m") * F.col("v")[j]).alias(f"v{j}") for j in range(width)])
    return product.select("word", F.array(*[f"v{j}" for j in range(width)]).alias("v"))


def _orthonormal(basis: DataFrame, width: int) -> DataFrame:
    """Columns of the same span, orthonormal up to the fixed-point places."""
    basis = _narrowed(basis)
    gram = _gram(basis, "v", "v", width)
    scale = np.sqrt(np.maximum(np.diag(gram), 1.0))
    eigen, turn = np.linalg.eigh(gram / scale[:, None] / scale[None, :])
    # Directions that are only rounding are left out as zero columns.
    inverse = np.where(eigen > 1e-9 * max(eigen.max(), 1e-300), 1 / np.sqrt(np.maximum(eigen, 1e-300)), 0.0)
    return written(_turned(basis, (turn * inverse) / scale[:, None], BASIS_BITS), "basis")
