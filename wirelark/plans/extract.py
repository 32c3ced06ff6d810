"""Telegram texts to records. One narrow map in Arrow batches: no shuffle, a failed text gives an error, not a failed job.

Python is used here because fields lean on places of all matches of multi-line patterns, which Spark's expressions do
not give; everything after the record is expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .rules import Rules
from .telegram import MARKINGS, parse

RECORD = """attrs map<string,string>, dtg struct<raw:string,precedence_raw:string,dd:string,hh:string,mm:string,mon:string,yy:string>,
dash_counters struct<raw:string,counter:int,filing_time:string,copies:int>,
distribution struct<raw:string,unknown_num:bigint,ACTION:map<string,int>,ORIGIN:map<string,int>,INFO:map<string,int>,sum_check:struct<expected:int,actual:int,valid:boolean>>,
`from` string, `to` string, info string, subject string, reference string, tags string, executive_order string, message_content string,
drafted_by array<string>, approved_by array<string>, handling_restrictions array<string>, classification_marker array<string>,
page_break array<struct<line:string,page:int>>, section_marker array<struct<raw:string,classification:string,section:int,total:int,mrn:string>>,
coverage struct<total:int,matched:int,blank:int,unmatched:int>, error string"""
#: Columns that a record has only if they are asked for: whether both marks stand once, the body's first.
ON_REQUEST = "has_body boolean"


def extracted(texts: DataFrame, key: str = "file", text: str = "text", markings: tuple[str, ...] = MARKINGS, read: Callable[[str, tuple[str, ...]], dict] | None = None, rules: Rules | None = None, columns: list[str] | None = None) -> DataFrame:
    """(key, record columns, error) of each text; a null text is an empty one.

    ``rules``: scans and rules beside the package's own; their fields are columns too. ``read`` makes a record of a text.
    ``columns``: the only ones to give; a text's whole record costs several times what its attributes or its counters do,
    and rules that no column needs are not run.
    """
    own = StructType.fromDDL(", ".join(f"`{n}` {ddl}" for n, ddl in rules.fields)).fields if rules and rules.fields else []
    given = [*StructType.fromDDL(RECORD).fields, *own]
    if columns is not None:
        named = {f.name: f for f in [*given, *StructType.fromDDL(ON_REQUEST).fields]}
        given = [named[c] for c in columns]
    schema = StructType([texts.schema[key], *given])
    arrow = to_arrow_schema(schema)
    asked = None if columns is None else frozenset(columns)
    one = read or partial(parse, rules=rules.giving(asked) if rules and asked is not None else rules, fields=asked)
    at_error = next((i for i, f in enumerate(given) if f.name == "error"), None)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows, errors = [], []
                for body in some.column(1).to_pylist():
                    try:
                        rows.append(one(body or "", markings))
                        errors.append(None)
                    except Exception as e:  # noqa: BLE001 - reported in the row
                        rows.append({})
                        errors.append(f"{type(e).__name__}: {e}"[:500])
                cells = [pa.array([r.get(f.name) for r in rows], f.type) for f in list(arrow)[1:]]
                if at_error is not None:
                    cells[at_error] = pa.array(errors, pa.string())
                yield pa.RecordBatch.from_arrays([some.column(0).cast(arrow.field(0).type), *cells], schema=arrow)

    return texts.select(key, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)
