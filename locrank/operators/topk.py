"""Ranking: the k best rows."""

from pyspark.sql import functions as F

# Fixed value: the length of the published ranking.
RANKING_SIZE = 40


def top_k(df, by, k=RANKING_SIZE, ties=("location",)):
    """The k rows with the highest `by`, nulls last, equal values in the order of `ties`.

    Plans as a top-k per partition and a merge of k rows each, not as a global sort.
    """
    order = [F.col(by).desc_nulls_last()] + [F.col(name).asc_nulls_last() for name in ties]
    return df.orderBy(*order).limit(k)
