"""Month-by-month (incremental) loading of the traffic model, batch and streaming."""
