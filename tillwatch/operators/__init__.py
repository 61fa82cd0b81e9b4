"""DataFrame -> DataFrame operators, the same ones for tables and (where stated) streams."""
