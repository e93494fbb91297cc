"""Plain full-refresh writes. For a path that others read meanwhile, use publish()."""


def replace_parquet(df, path):
    df.write.mode("overwrite").parquet(path)


def replace_csv(df, path):
    """CSV with a header line in each file. A ranking from top_k is one partition, so one file."""
    df.write.mode("overwrite").option("header", True).csv(path)
