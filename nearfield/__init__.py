"""Similarity search and clustering over Spark tables of dense vectors."""

import sys

from pyspark import cloudpickle

# Arrow kernels travel with the query, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from nearfield.index import VectorIndex, load_index, new_index  # noqa: E402
from nearfield.operators.kmeans import assign, kmeans_train  # noqa: E402
from nearfield.operators.knn import as_queries, cosine_knn, knn_join, self_knn  # noqa: E402
from nearfield.sources.table import VectorTable, validate_vectors, vector_table  # noqa: E402

__all__ = [
    "VectorIndex",
    "VectorTable",
    "as_queries",
    "assign",
    "cosine_knn",
    "kmeans_train",
    "knn_join",
    "load_index",
    "new_index",
    "self_knn",
    "validate_vectors",
    "vector_table",
]
