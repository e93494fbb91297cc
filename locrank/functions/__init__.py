from locrank.functions.columns import add_rates, fill_numeric_nulls, rename, safe_ratio

__all__ = ["add_rates", "fill_numeric_nulls", "rename", "safe_ratio"]
