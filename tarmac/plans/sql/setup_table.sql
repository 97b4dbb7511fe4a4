-- External table over a folder of clean Parquet files, with the clean
-- schema declared (not read from the files).
-- Parameters: :table (name, may be db.name); variables ${columns} (the
-- column list, see tarmac.schema.CLEAN_DDL) and ${path} (the folder).
CREATE TABLE IF NOT EXISTS IDENTIFIER(:table) (${columns})
USING parquet
LOCATION '${path}'
