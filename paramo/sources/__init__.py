"""Sources (star schema, wide normals table) and sinks (labels, bundles)."""
