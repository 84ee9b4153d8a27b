"""The stages that chain the operators: inventory, layout, chunks, index, fields, measures. Each reads and commits a store."""
