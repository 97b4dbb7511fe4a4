-- External table over a volume in folders by value (``month=1/``), its
-- folders found and registered as partitions, so that a filter on the
-- folder columns lists only the folders it needs.
-- Parameters: :table; variables ${columns} (the column list, folder columns
-- included), ${folders} (the folder columns) and ${path}.
CREATE TABLE IF NOT EXISTS IDENTIFIER(:table) (${columns})
USING parquet
PARTITIONED BY (${folders})
LOCATION '${path}';
MSCK REPAIR TABLE IDENTIFIER(:table)
