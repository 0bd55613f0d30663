"""Sources: driver-table bindings, broker/file envelopes, lake tables, synthetic rows."""
