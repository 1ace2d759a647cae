"""Stage functions: DataFrame -> DataFrame (lazy), one per step of the segmentation."""
