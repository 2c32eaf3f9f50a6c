"""Category encoding: frequency index, one-hot vectors, principal components."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value of the encoding.
COMPONENTS = 15


@dataclass(frozen=True)
class CategoryEncoding:
    """Fitted stages; ``transform`` adds index, one-hot and component columns."""

    model: PipelineModel
    one_hot_column: str
    pca_column: str

    @property
    def labels(self) -> list[str]:
        return self.model.stages[0].labelsArray[0]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def index_categories(df: DataFrame, column: str, output: str, *, invalid: str = "error") -> DataFrame:
    """Index of each value by descending frequency, ties in alphabetical order.

    ``invalid`` says what a null does: ``error``, ``skip`` the row, or ``keep`` it
    as an index of its own.
    """
    indexer = StringIndexer(
        inputCol=column, outputCol=output, stringOrderType="frequencyDesc", handleInvalid=invalid
    )
    return indexer.fit(df).transform(df)


def fit_category_encoding(
    df: DataFrame, column: str = "category", *, k: int = COMPONENTS, invalid: str = "error"
) -> CategoryEncoding:
    """Fit index, one-hot (all levels kept) and a projection to ``k`` components."""
    index, one_hot, components = f"{column}Index", f"{column}OneHot", f"{column}PCA"
    indexer = StringIndexer(
        inputCol=column, outputCol=index, stringOrderType="frequencyDesc", handleInvalid=invalid
    ).fit(df)
    indexed = indexer.transform(df.select(column))
    encoder = OneHotEncoder(inputCol=index, outputCol=one_hot, dropLast=False).fit(indexed)
    pca = PCA(k=k, inputCol=one_hot, outputCol=components).fit(encoder.transform(indexed))
    return CategoryEncoding(PipelineModel([indexer, encoder, pca]), one_hot, components)


def mean_one_hot(df: DataFrame, column: str = "category", *, invalid: str = "error") -> DataFrame:
    """One row: number of rows and element-wise mean of the one-hot vectors, without any projection."""
    index, one_hot = f"{column}Index", f"{column}OneHot"
    indexed = index_categories(df.select(column), column, index, invalid=invalid)
    encoded = OneHotEncoder(inputCol=index, outputCol=one_hot, dropLast=False).fit(indexed).transform(indexed)
    mean = encoded.agg(F.count(F.lit(1)).alias("count_total"), Summarizer.mean(F.col(one_hot)).alias(one_hot))
    return mean.select("count_total", vector_to_array(one_hot).alias(f"meanVector_{one_hot}"))


def mean_vectors(df: DataFrame, encoding: CategoryEncoding) -> DataFrame:
    """One row: element-wise means of the one-hot and of the projected vectors.

    The projection is linear and not centred, so the mean of the projected rows is
    the projected mean, and only the one-hot vectors of the rows are needed.
    """
    indexer, encoder, pca = encoding.model.stages
    one_hot = encoder.transform(indexer.transform(df.select(indexer.getInputCol())))
    mean = one_hot.agg(
        F.count(F.lit(1)).alias("count_total"),
        Summarizer.mean(F.col(encoding.one_hot_column)).alias(encoding.one_hot_column),
    )
    return pca.transform(mean).select(
        "count_total",
        vector_to_array(encoding.one_hot_column).alias(f"meanVector_{encoding.one_hot_column}"),
        vector_to_array(encoding.pca_column).alias(f"meanVector_{encoding.pca_column}"),
    )
