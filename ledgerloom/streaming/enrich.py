"""Late enrichment: pages of known addresses that are read again may fill gaps, and change nothing else."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ledgerloom.functions import urls as U
from ledgerloom.streaming.limiter import ROCKS  # noqa: F401  the session's state store must be RocksDB

#: Pages of a source that one refresh takes.
MOST = 50


def is_empty(value) -> bool:
    return value is None or value == [] or value == {} or isinstance(value, str) and not value.strip()


def filled(old: dict, new: dict) -> dict:
    """``old`` with what it lacks taken from ``new``: empty values, and in lists the elements that are new."""
    out = dict(old)
    for name, value in new.items():
        had = out.get(name)
        if isinstance(had, list) or isinstance(value, list):
            seen = {json.dumps(x, sort_keys=True): x for x in [*(had or []), *(value or [])]}
            out[name] = list(seen.values()) if value else had
        elif is_empty(had) and not is_empty(value):
            out[name] = value
    return out


class Filling(StatefulProcessor):
    """The row of an address (and unit), as it is now. The first row that comes is what the archive has; later ones, however late, only fill it."""

    def init(self, handle) -> None:
        self.row = handle.getValueState("row", "json string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = json.loads(self.row.get()[0]) if self.row.exists() else None
        before = now
        for frame in rows:
            for known, _, text in sorted(zip(frame["known"], frame["at"], frame["json"], strict=True), key=lambda x: (not x[0], x[1], x[2])):
                new = json.loads(text)
                if now is None:
                    # what is not in the archive yet is no refresh: it comes in by the upsert
                    now = new if known else None
                else:
                    now = filled(now, new)
        if now is not None and now != before:
            self.row.update((json.dumps(now),))
            yield pd.DataFrame({"url_key": [key[0]], "unit": [key[1]], "json": [json.dumps(now)], "first": [before is None]})

    def close(self) -> None:
        pass


def enriched(known: DataFrame, pages: DataFrame, url: str = "sourceUrl", unit=("bhk", "superBuiltUpArea")) -> DataFrame:
    """(url_key, unit, json, first): the rows of addresses whenever they change, from two streams of unit rows with a time ``at``.

    ``known``: what the archive has, ``pages``: what was read again, at any later time and in any order, as often as it likes. There is no bound
    on lateness, so the state, one row an address and unit on disk, is kept for good. Rows of addresses that are not known give nothing.
    """

    def keyed(df: DataFrame, is_known: bool) -> DataFrame:
        own = [c for c in df.columns if c != "at"]
        part = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in unit])
        return df.select(U.url_key(url).alias("url_key"), part.alias("unit"), F.unix_micros("at").alias("at"), F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("json"), F.lit(is_known).alias("known"))

    rows = keyed(known, True).unionByName(keyed(pages, False)).where("url_key is not null")
    return rows.groupBy("url_key", "unit").transformWithStateInPandas(Filling(), "url_key string, unit string, json string, first boolean", outputMode="Update", timeMode="None")
