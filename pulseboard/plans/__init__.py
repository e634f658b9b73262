"""Jobs: the metrics job context, the hub, and the snapshot history jobs."""
