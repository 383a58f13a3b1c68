"""What a run leaves behind: layers, targets, state tables. Plain Parquet in plain folders."""
