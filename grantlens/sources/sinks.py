"""Tables as files: CSV, TSV and JSON lines, and reading them back."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def landing(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, or else in the warehouse: driver and executors share both."""
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, path: str, kind: str, order: list | None = None) -> None:
    """kind: csv, tsv or json; order sorts over all files, for readers that want it, and only here."""
    out = df.orderBy(*order) if order else df
    if kind == "json":
        out.write.mode("overwrite").json(path)
    else:
        out.write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).option("sep", "," if kind == "csv" else "\t").option("quote", '"').option("escape", '"').csv(path)


def read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    if kind == "json":
        return spark.read.schema(schema).json(path)
    return spark.read.schema(schema).option("header", True).option("sep", "," if kind == "csv" else "\t").option("quote", '"').option("escape", '"').csv(path)


def write_nested(rows: DataFrame, path: str, by: list[str], order: list, levels: list[str]) -> None:
    """Documents of nested lists as files (gzip), each a JSON array of all documents of one task.

    rows: `depth` and `body`, a JSON object, besides the columns of `by` and `order`. Depth 0 begins a document, depth 1
    an entry of its list levels[0], depth 2 one of that entry's list levels[1], and so on. Rows of one `by` go to one
    task, in `order`, and pass one by one: a document's lists are never held.
    """
    deepest = len(levels)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_levels, filled = 0, False  # how many objects are open; whether the innermost list has an entry
        yield pd.DataFrame({"value": ["["]})
        some = False
        for b in batches:
            out = []
            for depth, body in zip(b["depth"], b["body"], strict=True):
                end = ""
                while open_levels > depth:
                    open_levels, filled = open_levels - 1, True
                    end += "]}"
                comma = "," if (filled if depth else some) else ""
                some = True
                if depth < deepest:
                    inner = body.rstrip()[:-1]
                    body = inner + ("," if inner.strip() != "{" else "") + f'"{levels[depth]}":['
                    open_levels, filled = depth + 1, False
                else:
                    filled = True
                out.append(end + comma + body)
            yield pd.DataFrame({"value": out})
        yield pd.DataFrame({"value": ["]}" * open_levels + "]"]})

    columns = [*by, "depth", "body", *[c for c in order if isinstance(c, str) and c not in (*by, "depth", "body")]]
    dealt = rows.select(*dict.fromkeys(columns)).repartition(*by).sortWithinPartitions(*by, *order)
    dealt.select("depth", "body").mapInPandas(run, "value string").write.mode("overwrite").option("compression", "gzip").text(path)


def read_nested(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def round_trip(df: DataFrame, name: str, kind: str, order: list | None = None) -> DataFrame:
    """df written as a file and read again."""
    spark = df.sparkSession
    path = landing(spark, name)
    write(df, path, kind, order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return read(spark, path, kind, schema)
