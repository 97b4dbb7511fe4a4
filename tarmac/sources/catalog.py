"""Catalog tables and SQL-text execution.

Values and identifiers are bound with Spark's named parameter markers
(``:name``, ``IDENTIFIER(:name)``).  Only ``${name}`` variables, for paths
in DDL where markers are not allowed, are put into the text, after a check.
"""

from __future__ import annotations

import re
from importlib import resources
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SQL_DIR = resources.files("tarmac.plans").joinpath("sql")  # also readable from a zipped package


def register_table(spark: SparkSession, name: str, path: str | None = None,
                   db: str | None = None, source: str = "parquet",
                   df: DataFrame | None = None, replace: bool = True,
                   schema=None, partitioned_by: list[str] | None = None) -> str:
    """Expose a dataset under ``[db.]name``.

    ``partitioned_by``: the folder columns (``month=1/``) of a partitioned
    dataset, by DDL with partition recovery; needs ``path`` and ``schema``.

    With ``path``: an external table over the folder (dropped and created
    again when ``replace``), like an external Hive table over Parquet.
    With ``df``: a temporary view (no catalog write).  ``schema`` fixes the
    table's columns and types (like a DDL column list) instead of reading
    them from the files.
    """
    if df is not None:
        df.createOrReplaceTempView(name)
        return name
    if db:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": db})
    full = f"{db}.{name}" if db else name
    if replace:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": full})
    if partitioned_by:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        run_sql_file(spark, "setup_partitioned", {"table": full},
                     {"columns": columns, "folders": ", ".join(partitioned_by), "path": path})
    else:
        spark.catalog.createTable(full, path=path, source=source, schema=schema)
    return full


def use_db(spark: SparkSession, db: str) -> None:
    spark.catalog.setCurrentDatabase(db)


_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def split_statements(text: str) -> list[str]:
    """Statements of a SQL text: cut at semicolons outside of quotes and comments."""
    token = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.S)
    cuts = [m.start() for m in token.finditer(text) if m[0] == ";"]
    parts = [text[a:b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(text)])]
    blank = re.compile(r"(?:\s|--[^\n]*(?:\n|$)|/\*.*?\*/)*", re.S)
    return [p.strip() for p in parts if not blank.fullmatch(p)]


def run_sql_text(spark: SparkSession, text: str, args: dict | None = None,
                 variables: dict | None = None) -> DataFrame:
    """Run the statements of a text; returns the last one's (lazy) result.

    ``args`` bind ``:name`` parameter markers.  ``variables`` replace
    Hive-style ``${name}`` references, for what markers cannot hold: a path
    or a column list in DDL.  Their values may hold no quote, backslash,
    semicolon or line break, and a reference without a value is an error.  No session
    setting changes, so threads may share a session.
    """
    variables = {k: str(v) for k, v in (variables or {}).items()}
    bad = [k for k, v in variables.items() if re.search(r"['\"`\\\n;]", v)]
    if bad:
        raise ValueError(f"variables with quotes or line breaks: {bad}")
    missing = set(_VARIABLE.findall(text)) - set(variables)
    if missing:
        raise ValueError(f"no value for variables: {sorted(missing)}")
    statements = split_statements(_VARIABLE.sub(lambda m: variables[m[1]], text))
    if not statements:
        raise ValueError("no statement")
    for statement in statements[:-1]:
        spark.sql(statement, args=args or None)
    return spark.sql(statements[-1], args=args or None)


def run_sql_file(spark: SparkSession, path: str | Path, args: dict | None = None,
                 variables: dict | None = None) -> DataFrame:
    """Run a SQL file.  A bare name without suffix is a file of the package;
    anything else must exist."""
    p = Path(path)
    if not p.suffix and p.name == str(path):
        p = SQL_DIR.joinpath(f"{p.name}.sql")
    if not p.is_file():
        raise FileNotFoundError(f"no SQL file {path}")
    return run_sql_text(spark, p.read_text(), args, variables)
