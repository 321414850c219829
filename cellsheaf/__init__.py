"""Earth-observation tables on Spark: scenes, pixels, swaths and manifests as DataFrames."""
