"""sievewright: watch-list standardisation and corpus preparation on Spark DataFrames."""
