"""Asking models about rows of a table, with a table of replies as memory.

Requests are keyed by a hash of all that can change the reply. Replies that are known come from the
table by a join; the rest are asked for once per distinct key, and their replies are written before
anything reads them, so that neither a retried task nor a second use asks again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions import text as T
from chalkline.functions.parsing import UnusableReply
from chalkline.providers import Provider
from chalkline.shipping import ship


def ask_twice(ask: Callable[[str], str], prompt: str, parse: Callable[[str], object]) -> object | None:
    """The parsed reply; after an unusable one, of a second request that names the fault; else None."""
    now = prompt
    for _ in range(2):
        try:
            return parse(ask(now))
        except UnusableReply as error:
            now = f"{prompt}\n\nThe last answer was of no use: {error}. Answer with one valid JSON object that follows the schema, and nothing else."
    return None


def complete_table(rows: DataFrame, keys: list[str], provider: Provider, model: str, parse: Callable[[str], object], reply: str) -> DataFrame:
    """``keys`` and ``reply`` for each row's ``prompt``; null for a reply that cannot be used. Provider errors end the job."""

    def work(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            found = [ask_twice(lambda p: provider.complete(p, model=model), prompt, parse) for prompt in table["prompt"]]
            yield pd.DataFrame({**{k: table[k] for k in keys}, "reply": pd.Series(found, dtype=object, index=table.index)})

    ship(rows.sparkSession)
    kinds = dict(rows.dtypes)
    return rows.select(*keys, "prompt").mapInPandas(work, ", ".join(f"{k} {kinds[k]}" for k in keys) + f", reply {reply}")


def vision_table(rows: DataFrame, keys: list[str], provider: Provider, model: str, prompt: str, parse: Callable[[str], object], reply: str) -> DataFrame:
    """``keys`` and ``reply`` for each row's ``image`` (bytes) and ``mime``; null where the reply cannot be used or the provider fails."""

    def one(image: bytes, mime: str) -> object | None:
        try:
            return ask_twice(lambda p: provider.vision(p, image, mime, model=model), prompt, parse)
        except Exception:  # one frame that fails does not end the video
            return None

    def work(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in tables:
            found = [one(bytes(i), m) for i, m in zip(table["image"], table["mime"])]
            yield pd.DataFrame({**{k: table[k] for k in keys}, "reply": pd.Series(found, dtype=object, index=table.index)})

    ship(rows.sparkSession)
    kinds = dict(rows.dtypes)
    return rows.select(*keys, "image", "mime").mapInPandas(work, ", ".join(f"{k} {kinds[k]}" for k in keys) + f", reply {reply}")


def keyed(rows: DataFrame, operation: str, model: str, *fields: str) -> DataFrame:
    """``rows`` with ``key``: the hash of operation, model and the named columns; binary ones count by their own hash."""
    kinds = dict(rows.dtypes)
    value = lambda c: F.sha2(F.col(c), 256) if kinds[c] == "binary" else F.col(c)
    named = {"model": F.lit(model), "operation": F.lit(operation)} | {c: value(c) for c in fields}
    return rows.withColumn("key", T.request_key(*[named[c].alias(c) for c in sorted(named)]))


def remembered(requests: DataFrame, memory: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(replies, added): a row (key, response) for every key of ``requests``, and the rows that memory lacked.

    ``ask`` takes the distinct requests that memory lacks and returns (key, response). Append ``added``
    to the memory before using ``replies``, or let ``ask`` return a written table.
    """
    wanted = requests.dropDuplicates(["key"])
    added = ask(wanted.join(memory.select("key"), "key", "left_anti")).select("key", "response")
    known = memory.join(wanted.select("key"), "key", "left_semi").select("key", "response")
    return known.unionByName(added), added
