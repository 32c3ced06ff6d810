"""Small dictionaries as columns: a key is found by its hash, whatever the number of entries."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A dictionary goes to every task with the plan, so its size is bounded; join a table instead of a larger one.
MOST_ENTRIES, MOST_BYTES = 65_536, 8 << 20


class Lookup:
    """Text to a value of some DDL type, null for other texts.

    Keys are dealt to buckets of about four by their CRC; the table of buckets is one constant of the plan.
    """

    def __init__(self, entries: dict[str, object], kind: str = "string"):
        self.kind, self.buckets = kind, [{} for _ in range(max(1, len(entries) // 4))]
        for key, value in sorted(entries.items()):
            self.buckets[zlib.crc32(key.encode()) % len(self.buckets)][key] = value
        self.text = json.dumps(self.buckets)
        if len(entries) > MOST_ENTRIES or len(self.text) > MOST_BYTES:
            raise ValueError(f"{len(entries)} entries of {len(self.text)} bytes are too many for a plan: join a table")

    def __getitem__(self, key: Column) -> Column:
        table = F.from_json(F.lit(self.text), f"array<map<string,{self.kind}>>")
        return F.get(table, (F.crc32(key.cast("binary")) % len(self.buckets)).cast("int"))[key]
