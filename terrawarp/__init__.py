"""terrawarp: raster-segmentation data processing as PySpark DataFrame operators."""
