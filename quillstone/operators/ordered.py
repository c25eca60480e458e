"""Operators that walk rows in order with a small state: workflow decisions, anchored lines, running lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Callable, added: str) -> DataFrame:
    """Rows with added columns: step(state, row) -> (state, values) in the order of each key, state None at its start.

    Rows are sorted within partitions and pass in batches, so a key of any length needs no more memory than a batch.
    """
    names = [c.split(" ")[0] for c in added.split(", ")]
    columns, schema = df.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for row in batch.astype(object).where(batch.notna(), None).to_dict("records"):
                here = tuple(row[k] for k in keys)
                if here != at:
                    at, state = here, None
                state, values = step(state, row)
                out.append({**row, **dict(zip(names, values, strict=True))})
            if out:
                yield pd.DataFrame(out, columns=[*columns, *names])

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, f"{schema}, {added}")


# The states in which a step may be taken, and where it leads
STEPS = {
    "propose": (("new", "deferred"), "proposed"),
    "confirm": (("proposed",), "accepted"),
    "reject": (("new", "proposed", "deferred"), "rejected"),
    "defer": (("new", "proposed"), "deferred"),
    "reopen": (("rejected", "deferred", "proposed"), "new"),
}


def decide(events: DataFrame) -> DataFrame:
    """Events (item, seq, action, person, note) with status after each, proposer and refused (null if it took effect).

    An item starts as new. Another person than the proposer confirms; a rejection needs a note; a step that the state does
    not allow changes nothing. Unknown actions are refused.
    """

    def step(state, row):
        status, proposer = state or ("new", None)
        allowed, to = STEPS.get(row["action"], ((), None))
        why = None
        if status not in allowed:
            why = "state"
        elif row["action"] == "confirm" and (row["person"] is None or row["person"] == proposer):
            why = "same person"
        elif row["action"] == "reject" and not (row["note"] or "").strip():
            why = "no note"
        if why is None:
            status, proposer = to, row["person"] if to == "proposed" else proposer if to == "accepted" else None
        return (status, proposer), (status, proposer, why)

    return fold(events.select("item", "seq", "action", "person", "note"), ["item"], ["seq"], step, "status string, proposer string, refused string")


def anchored_lines(words: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """doc, page, line, top, text of words (doc, page, top, x0, text): a word within the tolerance of the top of a line's
    first word stands in it; words of a line go by x0."""

    def step(state, row):
        line, top = state or (-1, None)
        if top is None or abs(row["top"] - top) > tolerance:
            line, top = line + 1, row["top"]
        return (line, top), (line, top)

    placed = fold(words.select("doc", "page", "top", "x0", "text"), ["doc", "page"], ["top", "x0", "text"], step, "line int, anchor double")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("x0", "top", "text"))), lambda x: x["text"])
    return placed.groupBy("doc", "page", "line").agg(F.min("anchor").alias("top"), F.array_join(texts, " ").alias("text"))


def running_lines(lines: DataFrame, share: float = 0.25, least: int = 3) -> DataFrame:
    """Lines (doc, page, text, in_margin) without those in margins whose text, digits aside, stands in the margins of
    max(least, share of the document's pages) pages, and without page numbers there."""
    text = F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), r"\d+", "#"), r"\s+", " "))
    named = lines.withColumn("_qs_text", text)
    pages = lines.groupBy("doc").agg(F.countDistinct("page").alias("_qs_pages"))
    seen = named.where("in_margin").groupBy("doc", "_qs_text").agg(F.countDistinct("page").alias("_qs_on")).join(pages, "doc")
    running = seen.where(F.col("_qs_on") >= F.greatest(F.lit(float(least)), F.col("_qs_pages") * share)).select("doc", "_qs_text", F.lit(True).alias("_qs_runs"))
    number = F.col("text").rlike(r"^\W*\d+\W*$")
    out = named.join(running, ["doc", "_qs_text"], "left")
    return out.where(~F.col("in_margin") | (F.col("_qs_runs").isNull() & ~number)).select(*lines.columns)
