"""Building-stock analytics on Spark: DataFrame in, DataFrame out."""
